"""License scan: ordered signature rules over the words of a text. Only DataFrame operations.

A signature is a regular expression over consecutive words. Texts without any of a few gate words
are passed over; of the rest, a rule runs where its keyword occurs. Of the places found, one that
lies inside another is dropped (of equal places all but the one of the first rule), so that
"GNU Lesser General Public License version 3" is not reported as a GPL as well.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import unique_name, without

#: words: runs of ASCII letters and digits and of all characters beyond ASCII, in lower case
SPLIT = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
LOWER_WORD = rf"[^{SPLIT}]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases that must be found and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Every signature has one of these in its words (or "cc" followed by a known word).
GATE = (
    r"(?i)licen[cs]|copyright|spdx|gpl|creative|wtfpl|redistribut|"
    r"cc(?:0|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+(?:by|0|zero))"
)

# Names of licenses and their versions. In a signature "[x]" is an optional word and "a|b" a choice.
FAMILIES = (
    ("gpl", ("gnu general public licen[sc]e", "gnu gpl", "gnu public licen[sc]e"), ("1", "2", "3")),
    ("lgpl", ("gnu lesser general public licen[sc]e", "gnu library general public licen[sc]e", "gnu lgpl", "lesser general public licen[sc]e"), ("2", "2 1", "3")),
    ("agpl", ("gnu affero general public licen[sc]e", "affero general public licen[sc]e", "gnu agpl"), ("1", "3")),
    ("gfdl", ("gnu free documentation licen[sc]e", "free documentation licen[sc]e"), ("1 1", "1 2", "1 3")),
    ("apache", ("apache [software] licen[sc]e", "apache software foundation licen[sc]e"), ("1", "1 1", "2")),
    ("mpl", ("mozilla public licen[sc]e",), ("1", "1 1", "2")),
    ("epl", ("eclipse public licen[sc]e",), ("1", "2")),
    ("cddl", ("common development and distribution licen[sc]e",), ("1", "1 1")),
    ("cpl", ("common public licen[sc]e",), ("1",)),
    ("eupl", ("european union public licen[sc]e",), ("1", "1 1", "1 2")),
    ("osl", ("open software licen[sc]e",), ("1", "2", "2 1", "3")),
    ("afl", ("academic free licen[sc]e",), ("1 1", "2", "2 1", "3")),
    ("artistic", ("artistic licen[sc]e", "perl artistic licen[sc]e"), ("1", "2")),
    ("bsl", ("boost software licen[sc]e",), ("1",)),
    ("busl", ("business source licen[sc]e",), ("1 1",)),
    ("psf", ("python software foundation licen[sc]e", "psf licen[sc]e"), ("2",)),
    ("php", ("php licen[sc]e",), ("3", "3 01")),
    ("zpl", ("zope public licen[sc]e",), ("2", "2 1")),
    ("ofl", ("sil open font licen[sc]e", "open font licen[sc]e"), ("1", "1 1")),
    ("odbl", ("open database licen[sc]e",), ("1",)),
    ("ms-pl", ("microsoft public licen[sc]e",), ()),
    ("ms-rl", ("microsoft reciprocal licen[sc]e",), ()),
    ("mit", ("mit licen[sc]e", "mit x11 licen[sc]e", "expat licen[sc]e", "x11 licen[sc]e"), ()),
    ("isc", ("isc licen[sc]e",), ()),
    ("zlib", ("zlib licen[sc]e", "zlib libpng licen[sc]e"), ()),
    ("bsd", ("bsd licen[sc]e", "berkeley software distribution licen[sc]e"), ()),
    ("bsd-2-clause", ("2 clause bsd licen[sc]e", "simplified bsd licen[sc]e", "freebsd licen[sc]e"), ()),
    ("bsd-3-clause", ("3 clause bsd licen[sc]e", "new bsd licen[sc]e", "modified bsd licen[sc]e", "revised bsd licen[sc]e"), ()),
    ("bsd-4-clause", ("4 clause bsd licen[sc]e", "original bsd licen[sc]e"), ()),
    ("unlicense", ("unlicense", "the unlicense licen[sc]e"), ()),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public licen[sc]e"), ("2",)),
    ("openssl", ("openssl licen[sc]e",), ()),
    ("ncsa", ("university of illinois ncsa open source licen[sc]e", "ncsa licen[sc]e"), ()),
    ("postgresql", ("postgresql licen[sc]e",), ()),
    ("curl", ("curl licen[sc]e",), ()),
    ("vim", ("vim licen[sc]e",), ()),
    ("proprietary", ("commercial licen[sc]e", "proprietary licen[sc]e", "end user licen[sc]e agreement"), ()),
)
COMMONS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
COMMONS_NAMES = {
    "by": "attribution", "by sa": "attribution share|sharealike [alike]", "by nc": "attribution noncommercial|non [commercial]",
    "by nd": "attribution noderivatives|noderivs|no [derivatives]", "by nc sa": "attribution noncommercial sharealike",
    "by nc nd": "attribution noncommercial noderivatives|noderivs",
}
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
SPDX = {
    "gpl": ("gpl 1 0", "gpl 2 0", "gpl 3 0"), "lgpl": ("lgpl 2 0", "lgpl 2 1", "lgpl 3 0"), "agpl": ("agpl 1 0", "agpl 3 0"),
    "apache": ("apache 1 0", "apache 1 1", "apache 2 0"), "mpl": ("mpl 1 0", "mpl 1 1", "mpl 2 0"), "epl": ("epl 1 0", "epl 2 0"),
    "mit": ("mit",), "isc": ("isc",), "zlib": ("zlib",), "bsl": ("bsl 1 0",), "unlicense": ("unlicense",), "wtfpl": ("wtfpl",),
    "bsd-2-clause": ("bsd 2 clause",), "bsd-3-clause": ("bsd 3 clause",), "bsd-4-clause": ("bsd 4 clause",),
    "artistic": ("artistic 1 0", "artistic 2 0"), "cddl": ("cddl 1 0", "cddl 1 1"), "ofl": ("ofl 1 0", "ofl 1 1"),
    "psf": ("psf 2 0", "python 2 0"), "cc0": ("cc0 1 0",),
}
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "copyright"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "copyright notice"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose [with] [or] [without] [fee]", "copyright"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use"),
    ("bsd-3-clause", "neither the name of .+ nor the names of its contributors [may]", "copyright"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "can redistribute it"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", "can redistribute it"),
    ("apache", "you may not use this file except in compliance with the license", "compliance with the license"),
    ("zlib", "altered source versions must be plainly marked as such", "copyright"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "license"),
    ("proprietary", "all rights reserved", "copyright"),
    ("notice", "licensed under the", "licensed under"),
    ("notice", "copyright c|20[0-9][0-9]|19[0-9][0-9]", "copyright"),
)


def rules() -> list[dict]:
    """All rules, first ones first: identifiers, names with a version, names, notices."""
    out: list[tuple[str, str, str, float]] = []  # label, signature, keyword, weight
    later = "[or] [any] [later] [version]"
    for label, ids in SPDX.items():
        for one in ids:
            name = label if " " not in one or label.startswith("bsd-") else f"{label}-{one.split(' ', 1)[1].replace(' ', '.')}"
            out.append((name, f"spdx license identifier {one} [only|or] [later]", "spdx license identifier", 1.0))
            if " " in one:
                out.append((name, f"license {one} [only|or] [later]", "license", 0.9))
    for parts in COMMONS:
        for version in COMMONS_VERSIONS:
            label = f"cc-{parts.replace(' ', '-')}-{version.replace(' ', '.')}"
            out.append((label, f"spdx license identifier cc {parts} {version}", "spdx license identifier", 1.0))
            out.append((label, f"cc {parts} [v] {version}", "cc by", 1.0))
            out.append((label, f"creative commons {COMMONS_NAMES[parts]} [international|unported|generic] {version}", "creative commons", 1.0))
            out.append((label, f"creativecommons org licenses {parts} {version}", "creativecommons org", 1.0))
        label = f"cc-{parts.replace(' ', '-')}"
        out.append((label, f"cc {parts}", "cc by", 0.9))
        out.append((label, f"creative commons {COMMONS_NAMES[parts]} [licen[sc]e]", "creative commons", 0.9))
        out.append((label, f"creativecommons org licenses {parts}", "creativecommons org", 0.9))
    out += [("cc0", s, k, 1.0) for s, k in (("cc0 [1] [0]", "cc0"), ("cc zero", "cc zero"), ("creative commons zero", "creative commons"), ("creativecommons org publicdomain zero", "creativecommons org"))]
    for label, names, versions in FAMILIES:
        for name in names:
            key = _keyword(name)
            for v in versions:
                full = f"{label}-{v.replace(' ', '.') if ' ' in v else v + '.0'}"
                number = v if " " in v else f"{v} [0]"
                for link in ("version", "v", "[the] [version]"):
                    out.append((full, f"{name} {link} {number} {later}", key, 1.0))
                out.append((full, f"{name} v{v.replace(' ', '.') if ' ' not in v else v} [0] {later}", key, 1.0))
            out.append((label, name, key, 0.9))
    for v in ("2", "3"):
        for label in ("gpl", "lgpl", "agpl"):
            out.append((f"{label}-{v}.0", f"{label}v{v} [or] [later]", f"{label}v{v}", 1.0))
    out += [(label, text, key, 0.7 if label != "notice" else 0.5) for label, text, key in NOTICES]
    return [{"place": i, "label": a, "pattern": _pattern(b), "ends": 2 if _long(b) else 1, "key": k, "weight": w} for i, (a, b, k, w) in enumerate(out)]


def _keyword(name: str) -> str:
    """The longest run of plain words that every match of a name has."""
    runs = [" ".join(r) for r in _plain_runs(name.split(" "))]
    return max(runs, key=len)


def _plain_runs(words: list[str]) -> list[list[str]]:
    runs: list[list[str]] = [[]]
    for w in words:
        if re.fullmatch(r"[0-9a-z]+", w):
            runs[-1].append(w)
        else:
            runs.append([])
    return [r for r in runs if r]


def _optional(word: str) -> bool:
    return word.startswith("[") and word.endswith("]")


def _long(signature: str) -> bool:
    return sum(not _optional(w) for w in signature.split(" ")) > 1


def _pattern(signature: str) -> str:
    """A signature over ``" word/place word/place ... "``: group 1 is the first place, group 2 the last needed."""
    words = signature.split(" ")
    needed = [i for i, w in enumerate(words) if not _optional(w)]
    out = ""
    for i, w in enumerate(words):
        body = w[1:-1] if _optional(w) else w
        body = r"[^ /]+(?:/\d+ [^ /]+){0,7}?" if body == ".+" else f"(?:{body})"
        place = r"/(\d+)" if i in (needed[0], needed[-1]) else r"/\d+"
        out += f"(?: {body}{place})?" if _optional(w) else f" {body}{place}"
    return out + "(?= )"


def scan(docs: DataFrame, text: str = "text", result: str = "scan", extra: bool = True) -> DataFrame:
    """``docs`` with a struct of what the text says about licenses; all columns and rows stay.

    n_words; n_base (places of the fixed phrases), first_word and last_word (smallest and largest
    start of them, words from 0, else null), base_labels; labels (also of the rules whose places
    lie in no other); score (weight of the strongest detection, else 0). Labels are distinct, sorted
    and comma-joined. A null text is empty. Everything stays in its row, so repeated rows give equal
    results and no group is ever formed. ``result`` must be a name that ``docs`` does not have.
    """
    docs = without(docs, [result])
    inner = [unique_name(docs, result + s) for s in ("_words", "_norm", "_line", "_base")]
    words, norm, line, base = inner
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = F.when(F.col(text).rlike(GATE), F.regexp_extract_all(F.translate(text, upper, lower), F.lit(LOWER_WORD), F.lit(0)))
    step = docs.withColumn(words, found)
    step = step.withColumn(norm, F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")))
    numbered = F.transform(words, lambda w, i: F.concat(F.lit(" "), w, F.lit("/"), i.cast("string")))
    step = step.withColumn(line, F.concat(F.array_join(numbered, ""), F.lit(" ")))

    def places(phrase: str) -> F.Column:
        starts = F.regexp_extract_all(F.col(line), F.lit(_pattern(phrase)), F.lit(1))
        return F.when(F.contains(F.col(norm), F.lit(f" {phrase} ")), F.transform(starts, lambda x: x.cast("long"))).otherwise(F.array().cast("array<bigint>"))

    step = step.withColumn(base, F.array(*(F.struct(F.lit(label).alias("label"), places(p).alias("at")) for p, label in BASE)))
    at = F.flatten(F.transform(base, lambda b: b["at"]))
    base_labels = F.transform(F.filter(base, lambda b: F.size(b["at"]) > 0), lambda b: b["label"])
    fields = "array<struct<place:int,label:string,pattern:string,ends:int,key:string,weight:double>>"
    listed = F.from_json(F.lit(json.dumps(rules() if extra else [])), fields)
    chosen = F.filter(listed, lambda r: F.contains(F.col(norm), r["key"]))

    def hits(rule: F.Column) -> F.Column:
        first = F.regexp_extract_all(F.col(line), rule["pattern"], F.lit(1))
        last = F.regexp_extract_all(F.col(line), rule["pattern"], rule["ends"])
        pair = F.arrays_zip(first.alias("first"), last.alias("last"))
        return F.transform(
            pair,
            lambda p: F.struct(
                p["first"].cast("long").alias("first"),
                (-p["last"].cast("long")).alias("last"),
                rule["place"].alias("place"),
                rule["label"].alias("label"),
                rule["weight"].alias("weight"),
            ),
        )

    # by start, then longest first: a place is inside another if one before it ends no earlier
    ordered = F.array_sort(F.flatten(F.transform(chosen, hits)))
    start = F.struct(F.lit(-1).cast("long").alias("end"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("weight"))

    def step_on(acc: F.Column, hit: F.Column) -> F.Column:
        new = -hit["last"] > acc["end"]
        return F.struct(
            F.greatest(acc["end"], -hit["last"]).alias("end"),
            F.when(new, F.array_union(acc["labels"], F.array(hit["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(new, F.greatest(acc["weight"], hit["weight"])).otherwise(acc["weight"]).alias("weight"),
        )

    more = F.aggregate(ordered, start, step_on)
    step = step.withColumn(result, F.when(F.col(words).isNotNull(), more))
    none = F.array().cast("array<string>")
    labels = F.array_union(base_labels, F.coalesce(F.col(f"{result}.labels"), none))
    out = F.struct(
        F.coalesce(F.regexp_count(F.col(text), F.lit(ANY_WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.coalesce(F.when(F.col(words).isNotNull(), F.size(at)), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.coalesce(F.array_join(F.array_sort(base_labels), ","), F.lit("")).alias("base_labels"),
        F.coalesce(F.array_join(F.array_sort(labels), ","), F.lit("")).alias("labels"),
        F.greatest(F.coalesce(F.col(f"{result}.weight"), F.lit(0.0)), F.when(F.size(base_labels) > 0, 0.9).otherwise(0.0)).alias("score"),
    )
    return step.withColumn(result, out).drop(*inner)
