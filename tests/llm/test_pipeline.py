"""The pipeline's stages against brute force on a small corpus, and the registered queries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline
from cohortspark.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(documents):
    rng = random.Random(1)
    words = ["ka", "to", "mi", "ru", "lo", "né", "pa"]
    text = lambda n: " ".join("".join(rng.choices(words, k=3)) for _ in range(n))
    rows = [(i, text(rng.randint(30, 90)), "aa", rng.choice("xyz")) for i in range(60)]
    passage = text(40)
    rows += [(100 + i, text(30) + " " + passage + " " + text(30), "aa", "x") for i in range(5)]
    rows += [(200, rows[0][1], "aa", "y"), (201, rows[1][1] + " end", "aa", "y")]
    rows += [(300, None, "aa", "x"), (301, "", "aa", "x"), (302, "12 34", None, None), (303, passage, None, None)]
    return documents(rows, extra=True), rows, passage


def test_stages(spark, docs):
    frame, rows, passage = docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "jaccard", "repeats", "mix", "encode"]
    now, stages = frame, dict(corpus_pipeline.STAGES)
    now = stages["language"](spark, now, "")
    assert now.columns == frame.columns
    # the prediction stands where the language was missing, and comes out at the end
    assert {r["lang"] for r in now.collect()} == {"aa"}
    left = {r["doc_id"] for r in now.collect()}
    assert left == {r[0] for r in rows} - {300, 301, 302}
    now = stages["jaccard"](spark, now, "")
    assert now.columns == frame.columns
    assert {r["doc_id"] for r in now.collect()} == left - {200, 201}
    now = stages["repeats"](spark, now, "")
    assert now.columns == frame.columns and now.schema["n_chars"] == frame.schema["n_chars"]
    cut = {r["doc_id"]: r for r in now.collect()}
    assert set(cut) == left - {200, 201, 303}  # the passage alone is gone
    texts = {r[0]: r[1] for r in rows}
    assert all(cut[i]["text"] == texts[i] for i in range(60)) and cut[100]["text"] == texts[100]
    assert all(len(cut[i]["text"]) <= len(texts[i]) - len(passage) for i in range(101, 105))
    assert all(r["n_chars"] == len(r["text"]) for r in cut.values())
    mix = stages["mix"](spark, now, "").cache()
    assert mix.columns == frame.columns
    copies = Counter(r["doc_id"] for r in mix.collect())
    assert set(copies.values()) <= {1, 2} and set(copies) <= set(cut)
    out = stages["encode"](spark, mix, "").collect()
    assert len(out) == sum(copies.values())
    assert {r["lang"] for r in out} == {"aa"}
    for r in out:
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(cut[r["doc_id"]]["text"].encode()).hexdigest()


@pytest.mark.parametrize("label", [None, "und"])
def test_language_stage_without_usable_labels(spark, documents, label):
    rows = [(i, f"ka to mi {i}", label) for i in range(30)] + [(100, None, label), (101, "", label), (102, "12 34", label)]
    now = dict(corpus_pipeline.STAGES)["language"](spark, documents(rows, extra=True), "")
    assert sorted(r["doc_id"] for r in now.collect()) == list(range(30))


def test_language_stage_fills_what_is_missing(spark, documents):
    rng = random.Random(3)
    kinds = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ein", "ung"]}
    say = lambda lang: " ".join("".join(rng.choices(kinds[lang], k=3)) for _ in range(20))
    truth = {i: ("aa", "bb")[i % 2] for i in range(80)}
    docs = documents([(i, say(lang), lang if i % 3 else None) for i, lang in truth.items()], extra=True)
    now = dict(corpus_pipeline.STAGES)["language"](spark, docs, "")
    assert now.columns == docs.columns
    assert {r["doc_id"]: r["lang"] for r in now.collect()} == truth


def test_jaccard_stage_tells_texts_of_one_id_apart(spark, documents):
    first, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, first), (2, first + " end"), (2, other), (2, None), (3, first), (3, first), (None, first)]
    docs = documents(rows, extra=True)
    now = dict(corpus_pipeline.STAGES)["jaccard"](spark, docs, "")
    assert now.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in now.collect()), key=str) == sorted([rows[0], rows[2], rows[3], rows[6]], key=str)


def test_stages_on_nothing(spark, documents):
    now = documents([], extra=True)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "")
    assert now.count() == 0


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    rows = queries.QUERIES[name](spark, FOLDER)
    count = rows.count()
    if name.startswith(("op8", "op10")):
        assert count > 0
    elif name != "pipeline":
        assert count == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_thirteen_operators_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in queries.QUERIES
