"""Cross-parsing against a plain parser, held-out accuracy, and the chain of classifiers."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import language, toxicity
from cohortspark.llm.common import pieces
from cohortspark.llm.words import MARKS, hashed_words, shingles

SYLLABLES = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ein", "ung", "ver"], "cc": ["ção", "ões", "lh", "nha"]}


def invented(rng, lang, words):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words))


def plain_phrases(sample: str, text: str) -> int:
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and text[at : at + size] in sample:
            size += 1
        at += size if text[at : at + 1] in sample else 1
        count += 1
    return count


@pytest.mark.parametrize("seed", range(5))
def test_phrases_match_a_plain_parser(seed):
    rng = random.Random(seed)
    sample = "".join(rng.choices("abc ", k=200)).strip()
    model = language.model_of({"x": [sample]})
    parser = language.Parser(model)
    squeezed = " ".join(sample.split())
    texts = [" ".join("".join(rng.choices("abcd ", k=rng.randint(1, 300))).split()) or "a" for _ in range(20)]
    got = parser.phrases([parser.symbols(t)[0] for t in texts])[0]
    assert got.tolist() == [plain_phrases(squeezed, t) for t in texts]


def test_long_texts_are_parsed_whole():
    rng = random.Random(8)
    samples = {"x": "abcabcabdabc", "y": "".join(rng.choices("abcd", k=300)), "z": "a" * 40 + "b"}
    model = language.model_of({n: [s] for n, s in samples.items()})
    parser = language.Parser(model)
    texts = ["abc" * 1700 + "q", "".join(rng.choices("abcd", k=5000)), "a" * 5000, "ab" * 2500, "q" * 600, "".join(rng.choices("abcq ", k=5000)), "", "a"]
    texts += ["".join(rng.choices("abcd", k=n)) for n in (6, 7, 8, 63, 64, 65, 127, 128, 129, 511, 512, 513, 1024)]
    found = parser.symbols
    want = [[plain_phrases(samples[n], re.sub(" +", " ", t).lstrip()) for t in texts] for n in model.languages]
    for block in (1, 7, 64, 512, 10_000):
        assert parser.phrases([found(t)[0] for t in texts], block).tolist() == want


def test_a_batch_of_large_texts_is_parsed_in_little_memory(monkeypatch):
    """A worker parses beside another one and a full JVM."""
    rng = random.Random(3)
    model = language.model_of({n: [invented(rng, n, 60)] for n in SYLLABLES})
    made = {}
    monkeypatch.setattr(language, "appended", lambda docs, text, kinds, make, size: made.update(make=make, size=size))
    language.predict(None, model)
    batch = pa.record_batch({"text": [invented(rng, "bb", 4000) for _ in range(250)]})
    assert batch.nbytes > 4 << 20
    call = made["make"]()
    tracemalloc.start()
    try:
        names = [n for piece in pieces(batch, 0, made["size"]) for n in call(piece.column(0).to_pylist())[0]]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert names == ["bb"] * 250
    assert peak < 32 << 20


def test_no_id_is_not_held_out(documents):
    got = {r.doc_id: r.held for r in documents([(None, "a"), (1, "b")]).select("doc_id", language.fold().alias("held")).collect()}
    assert got[None] is False


def test_every_letter_of_large_alphabets_counts(documents):
    """Two Han languages of some thousand letters each, half of them shared, beside one in Latin script."""
    rng = random.Random(5)
    han = [chr(0x4E00 + i) for i in range(6000)]
    words = {"h1": ["".join(rng.choices(han[:4000], k=2)) for _ in range(1500)], "h2": ["".join(rng.choices(han[2000:], k=2)) for _ in range(1500)], "aa": SYLLABLES["aa"]}
    say = lambda lang, n: "".join(rng.choices(words[lang], k=n))
    rows = [(i, say(lang := sorted(words)[i % 3], rng.randint(100, 200)), lang) for i in range(360)]
    model = language.learn(documents(rows), held_out=language.fold())
    assert len(model.letters) > 3000
    held = [r for r in language.predict(documents(rows).withColumn("held", language.fold()), model).collect() if r["held"]]
    assert len(held) > 40 and all(r["lang_pred"] == r["lang"] for r in held)
    # counts are those of a plain parser, with letters beyond the sample as well
    sample = say("h1", 300)
    parser = language.Parser(language.model_of({"x": [sample], "y": ["abc"]}))
    texts = [say(lang, 120) for lang in ("h1", "h2", "aa")] + [sample[40:400]]
    assert parser.phrases([parser.symbols(t)[0] for t in texts])[0].tolist() == [plain_phrases(sample, t) for t in texts]


def test_held_out_accuracy_and_odd_rows(documents):
    rng = random.Random(3)
    rows = [(i, invented(rng, lang := rng.choice(sorted(SYLLABLES)), rng.randint(5, 60)), lang) for i in range(400)]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "123 !!", "bb"), (1003, "ka to mi", None), (1003, "ka to mi", None), (None, "ein ung", "bb")]
    rows += [(1004, invented(rng, "cc", 40_000), "cc")]
    docs = documents(rows, extra=True)
    model = language.learn(docs, held_out=language.fold())
    out = language.predict(docs.withColumn("held", language.fold()), model).collect()
    assert len(out) == len(rows)
    by = {r["doc_id"]: r for r in out}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert by[1003]["lang_pred"] == "aa" and by[1004]["lang_pred"] == "cc"
    held = [r for r in out if r["held"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert held and all(r["lang_pred"] == r["lang"] for r in held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_held_out_rows_teach_nothing(documents):
    rows = [(i, "ka to mi ru", "aa") for i in range(50)]
    model = language.learn(documents(rows), held_out=F.lit(True))
    assert model.languages == []
    assert {r["lang_pred"] for r in language.predict(documents(rows), model).collect()} == {"und"}
    assert language.predict(documents([]), language.learn(documents([]))).count() == 0


def test_chain_finds_categories(documents, spark):
    rng = random.Random(9)
    clean, bad = ["w%d" % i for i in range(300)], ["vile", "scummy", "awful"]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(clean, k=rng.randint(20, 60))
        junk, toxic = i % 7 == 0, i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        if junk:
            words += ["zzjunk"] * 3
        rows.append((i, " ".join(words)))
        if i < 400:
            labels.append((i, 0 if junk else 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "VILE! " * 3), (1002, "VILE! " * 3)]
    labels += [(1000, None, None), (None, 1, 1), (5000, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(rows, extra=True)
    categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.learn(docs, marks, categories)
    assert [len(k.earlier) for k in chain.links] == [0, 1]
    out = {r["doc_id"]: r for r in toxicity.predict(docs, chain).collect()}
    wrong = [i for i in range(400, 600) if (out[i]["p_toxic"] >= 0.5) != (i % 5 == 0) or (out[i]["p_low_quality"] >= 0.5) != (i % 7 == 0)]
    assert len(wrong) <= 2
    assert out[1002]["p_toxic"] >= 0.5 and out[1000]["p_toxic"] < 0.5 and out[1001]["p_toxic"] < 0.5
    nothing = toxicity.learn(documents([]), marks, categories)
    assert all(r["p_toxic"] < 0.01 for r in toxicity.predict(docs, nothing).collect())


def test_a_link_is_a_penalised_logistic_regression():
    """Against Newton's method on the same scaled words, run to its end."""
    rng = np.random.default_rng(6)
    n, width = 500, 12
    words = rng.random((n, width)) < np.linspace(0.1, 0.6, width)
    earlier = rng.random((n, 1))
    y = rng.random(n) < 1 / (1 + np.exp(2 - 3 * words[:, 3] + 2 * words[:, 7] - 1.5 * earlier[:, 0]))
    doc, word = np.nonzero(words)
    rows, every = toxicity.Rows(doc, word, n), np.ones(n, bool)
    link = toxicity._fit("c", rows, width, y, earlier, every, steps=4000)
    # the scale of a word: log ratio of its shares, zero below the chi-square that counts
    yes, no = words[y].sum(0) + 0.5, words[~y].sum(0) + 0.5
    scale = np.log(yes / (y.sum() + 1)) - np.log(no / ((~y).sum() + 1))
    both = yes + no
    expected = both * y.mean()
    scale[(yes - expected) ** 2 / (expected * (1 - y.mean()) * np.maximum(1 - both / n, 0.01)) < toxicity.CHI_SQUARE] = 0
    assert 0 < (scale != 0).sum() < width
    x = np.column_stack([np.ones(n), words * scale, earlier])
    penalty = np.concatenate([[0], np.full(width, 0.02), [0]])
    w = np.zeros(width + 2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-12 * np.eye(width + 2)
        w -= np.linalg.solve(hess, x.T @ (p - y) + penalty * w)
    got = toxicity._probability(toxicity._odds(rows, link, earlier))
    assert np.abs(got - 1 / (1 + np.exp(-x @ w))).max() < 1e-3


def test_later_links_learn_from_predictions_out_of_fold(documents, spark, monkeypatch):
    """The probabilities a later link is fitted on come from models that have not seen the document."""
    seen = []
    fit = toxicity._fit
    monkeypatch.setattr(toxicity, "_fit", lambda name, rows, width, y, earlier, use, **k: seen.append((name, use.copy(), earlier.copy())) or fit(name, rows, width, y, earlier, use, **k))
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["w%d" % k for k in range(40)], k=15) + (["bad"] if i % 3 == 0 else []))) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 5 == 0)) for i, _ in rows], "doc_id long, a int, b int")
    toxicity.learn(documents(rows), labels, {"a": F.col("a") == 1, "b": F.col("b") == 1}, folds=3)
    first, second = [s for s in seen if s[0] == "a"], [s for s in seen if s[0] == "b"]
    assert [s[1].all() for s in first] == [False, False, False, True]
    left_out = np.array([~s[1] for s in first[:3]])
    assert (left_out.sum(0) == 1).all()  # each row is left out of one model, which gives its probability
    assert all(s[2].shape[1] == 0 for s in first) and all(s[2].shape[1] == 1 for s in second)


def test_toxicity_of_long_texts_and_rows_without_id(documents, spark):
    rows = [(i, "w%d w%d " % (i % 7, i % 11) * 5 + ("vile" if i % 4 == 0 else "fine")) for i in range(200)]
    odd = [(None, "vile"), (None, "vile"), (900, "w1 " * 200_000 + "vile"), (901, None)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1)], "doc_id long, toxic int")
    docs = documents(rows + odd)
    chain = toxicity.learn(docs, labels, {"toxic": F.col("toxic") == 1})
    got = [(r.doc_id, r.p_toxic) for r in toxicity.predict(docs, chain).collect()]
    assert len(got) == len(rows) + len(odd)
    assert [p >= 0.5 for i, p in got if i in (None, 900)] == [True] * 3 and dict(got)[901] < 0.5


def test_word_hashes_depend_on_words_alone():
    def words(texts, between=None, **options):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        args = () if between is None else (between,)
        hashes, places = hashed_words(data, np.cumsum([0, *map(len, raw)]), *args, **options)
        return [hashes[a:b].tolist() for a, b in zip(places[:-1], places[1:], strict=True)]

    one, two, three, four = words(["Ab cd", "cd\tab", "", "abcd ab"])
    assert one == two[::-1] and three == [] and four[1] == one[0] and four[0] not in one
    assert words(["x", "y"])[0] != words(["xy"])[0]
    assert words(["idiot!"], MARKS) == words(["idiot"], MARKS)
    long, short = words(["abcdefgh abcdefxy"], head=6)[0]
    assert long == short


def test_shingles_are_sets():
    raw = ["a b c d e f", "a b c d e f a b c d e f", "x", "", "x y"]
    data = np.frombuffer("".join(raw).encode(), np.uint8)
    tokens, at = shingles(*hashed_words(data, np.cumsum([0, *map(len, raw)])), 5)
    sizes = np.diff(at).tolist()
    assert sizes == [2, 6, 1, 0, 1]
    assert set(tokens[at[0] : at[1]].tolist()) <= set(tokens[at[1] : at[2]].tolist())
    assert tokens[at[2]] != tokens[at[4]]
