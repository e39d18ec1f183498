"""License scan against a plain scan of words."""

from __future__ import annotations

import random
import re

import pytest

from cohortspark.llm import licenses

TEXTS = [
    None,
    "",
    "no license here",
    "GNU General Public License, version 3 or later; the MIT-License and CC BY",
    "the mit license mit license",
    "Apache   License\n2.0 Apache License",
    "gnu general\tpublic licenses",
    "xmit license, mit licensed, mit license",
    "ümit license mit  license é",
    "GNU Lesser General Public License v2.1",
    "SPDX-License-Identifier: GPL-2.0-only",
    "Creative Commons Attribution-NonCommercial 4.0 (CC BY-NC 4.0)",
    "Licensed under the Apache License, Version 2.0.",
    "cc, by and cc0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "W" * 4000 + " mit license " + "x y " * 3000 + "MIT LICENSE",
    "mit license " * 300,
    "K mit license",
]
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for phrase, label in licenses.BASE:
        own = phrase.split(" ")
        places = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        at += places
        labels |= {label} if places else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


@pytest.fixture(scope="module")
def scanned(documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4])]
    return {r["doc_id"]: r for r in licenses.scan(documents(rows, extra=True)).collect()}


def test_base_phrases(scanned):
    for i, text in enumerate(TEXTS):
        s = scanned[i]["scan"]
        assert (s["n_words"], s["n_base"], s["first_word"], s["last_word"], s["base_labels"]) == base(text), text
        labels = [x for x in s["labels"].split(",") if x]
        assert labels == sorted(set(labels)) and set(s["base_labels"].split(",")) - {""} <= set(labels)
        assert 0 <= s["score"] <= 1


@pytest.mark.parametrize(
    ("i", "labels"),
    [
        (3, "cc-by,gpl,gpl-3.0,mit"),
        (9, "lgpl-2.1"),
        (10, "gpl-2.0"),
        (11, "cc-by,cc-by-nc-4.0"),
        (12, "apache,apache-2.0,notice"),
        (13, "cc-by,cc0"),
        (14, "bsd"),
    ],
)
def test_rules(scanned, i, labels):
    assert scanned[i]["scan"]["labels"] == labels


def test_rules_are_many_and_ordered():
    rules = licenses.rules()
    assert len(rules) >= 300 and [r["place"] for r in rules] == list(range(len(rules)))
    gate = re.compile(licenses.GATE)
    for r in rules:
        re.compile(r["pattern"])
        # no text that a rule matches is passed over at the gate
        words = re.sub(r"/\(?\\d\+\)?", "", r["pattern"]).replace("licen[sc]e", "license")
        words = re.sub(r"\(\?: [^)]*\)*\)\?|\(\?=? ?\)", "", words)
        assert gate.search(r["key"]) or gate.search(words), r


PIECES = [
    "GNU General Public License", "gnu lesser general public license", "version 3", "v2", "2.1", "or any later version", "or later", "Apache License",
    "Apache Software License", "2.0", "MIT License", "expat license", "SPDX-License-Identifier:", "GPL-2.0-only", "CC BY", "CC-BY-SA 4.0", "4.0",
    "Creative Commons Attribution", "NonCommercial ShareAlike", "international", "creativecommons.org/licenses/by/3.0", "cc0", "Copyright 2019",
    "All rights reserved", "licensed under the", "BSD License", "3-clause BSD license", "LGPLv3", "the", "of", "x",
    "you can redistribute it and/or modify it under the terms of the", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
]


def detections(text):
    """All detections by rule, without those inside another: labels and the greatest weight."""
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    line, norm = "".join(f" {w}/{i}" for i, w in enumerate(words)) + " ", f" {' '.join(words)} "
    hits = []
    if re.search(licenses.GATE, text):
        for r in licenses.rules():
            if r["key"] in norm:
                hits += [(int(m[1]), -int(m[r["ends"]]), r["place"], r["label"], r["weight"]) for m in re.finditer(r["pattern"], line)]
    kept = [h for h in hits if not any(g < h and g[0] <= h[0] and g[1] <= h[1] for g in hits)]
    return {h[3] for h in kept}, max((h[4] for h in kept), default=0.0), len(hits) - len(kept)


def test_containment_against_all_pairs(documents):
    draw = random.Random(7)
    texts = ["".join(draw.choice(PIECES) + draw.choice([" ", " ", ", ", "\n", " - "]) for _ in range(draw.randrange(1, 14))) for _ in range(250)]
    got = {r["doc_id"]: r["scan"] for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    inside = 0
    for i, text in enumerate(texts):
        labels, weight, dropped = detections(text)
        inside += dropped
        based = set(filter(None, base(text)[4].split(",")))
        assert got[i]["labels"] == ",".join(sorted(labels | based)), text
        assert got[i]["score"] == max(weight, 0.9 if based else 0.0)
    assert inside > 100


def test_no_rows(documents):
    assert licenses.scan(documents([])).count() == 0
