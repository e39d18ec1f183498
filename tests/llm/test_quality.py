"""The additive quality model: features, fits, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import quality
from cohortspark.llm.queries import QUERIES


def plain_features(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    lines = [x for x in raw.split(b"\n") if x]
    low = lambda w: bytes(b + 32 if 65 <= b <= 90 else b for b in w)
    n, m = max(len(raw), 1), max(len(words), 1)
    kinds = quality._KIND
    count = lambda k: sum(int(kinds[b]) == k for b in raw)
    letters = count(quality.UPPER) + count(quality.LOWER)
    marked = sum(int(kinds[w[-1]]) in (quality.POINT, quality.SYMBOL) for w in words)
    return [
        np.log2(1 + len(raw)), np.log2(1 + len(words)), sum(map(len, words)) / m, np.log2(1 + max(map(len, words), default=0)),
        count(quality.UPPER) / max(letters, 1), count(quality.DIGIT) / n, count(quality.POINT) / n, count(quality.SYMBOL) / n, count(quality.OTHER) / n,
        raw.count(b"\n") / n, sum(a == b for a, b in zip(raw, raw[1:], strict=False)) / n, marked / m, sum(len(w) < 2 for w in words) / m,
        sum(65 <= w[0] <= 90 for w in words) / m, len({low(w) for w in words}) / m, len({low(x) for x in lines}) / max(len(lines), 1),
        np.log2(1 + len(words) / max(len(lines), 1)),
    ]


def test_features_of_whole_texts():
    draw = random.Random(1)
    letters = "aB é1.,$\n\t|漢"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(0, 80))) for _ in range(200)]
    texts += [None, "", " ", "\n\n", "x", "Ab ab AB\nab ab ab\nAB AB AB", "w " * 60_000]
    got = quality.features(pa.array(texts, pa.string()))
    assert got.shape == (len(texts), len(quality.FEATURES))
    np.testing.assert_allclose(got, [plain_features(t) for t in texts])
    assert not got[len(texts) - 7 : len(texts) - 5].any()


def test_tree_takes_the_cut_that_gains_most():
    draw = np.random.default_rng(2)
    for _ in range(30):
        grad, hess = draw.normal(size=9), draw.uniform(0.5, 2, 9)
        best = max(
            (g[: k].sum() ** 2 / (h[: k].sum() + 1) + g[k:].sum() ** 2 / (h[k:].sum() + 1), k)
            for g, h in [(grad, hess)] for k in range(1, 9)
        )
        k = best[1]
        want = np.repeat([grad[:k].sum() / (hess[:k].sum() + 1), grad[k:].sum() / (hess[k:].sum() + 1)], [k, 9 - k])
        if best[0] > grad.sum() ** 2 / (hess.sum() + 1) + 1e-9:
            np.testing.assert_allclose(quality._tree(grad, hess, 1, 1.0, 0.0), want)
        grid, weight = draw.normal(size=(4, 5)), draw.uniform(0.5, 2, (4, 5))
        tried = {}
        for a in range(1, 4):
            for b in range(1, 5):
                parts = [np.s_[:a, :b], np.s_[:a, b:], np.s_[a:, :b], np.s_[a:, b:]]
                tried[a, b] = sum(grid[p].sum() ** 2 / (weight[p].sum() + 1) for p in parts)
        gain, step = quality._cross(grid, weight, 1.0, 0.0)
        a, b = max(tried, key=tried.get)
        assert gain == pytest.approx(tried[a, b])
        assert step[0, 0] == pytest.approx(grid[:a, :b].sum() / (weight[:a, :b].sum() + 1))
        assert step[-1, -1] == pytest.approx(grid[a:, b:].sum() / (weight[a:, b:].sum() + 1))


def test_pairs_learn_what_single_features_cannot():
    draw = np.random.default_rng(3)
    x = draw.uniform(size=(4000, 5))
    y = ((x[:, 1] > 0.5) != (x[:, 3] > 0.5)).astype(int)
    alone = quality.fit(x, y, np.ones(len(y)), interactions=0)
    both = quality.fit(x, y, np.ones(len(y)), interactions=2)
    assert np.mean((quality.score(alone, x) >= 0.5) == y) < 0.65
    assert both.pairs[0] == (1, 3)
    fresh = draw.uniform(size=(2000, 5))
    truth = (fresh[:, 1] > 0.5) != (fresh[:, 3] > 0.5)
    assert np.mean((quality.score(both, fresh) >= 0.5) == truth) > 0.95
    odds = np.log(quality.score(both, fresh) / (1 - quality.score(both, fresh)))
    fine, coarse = quality._bins(fresh, both.edges), quality._bins(fresh, both.pair_edges)
    for i in range(50):
        want = both.bias + sum(t[b] for t, b in zip(both.tables, fine[i], strict=True)) + sum(g[coarse[i, a], coarse[i, b]] for (a, b), g in zip(both.pairs, both.grids, strict=True))
        assert odds[i] == pytest.approx(want, abs=1e-6)


def corpus(count):
    draw = random.Random(4)
    rows = []
    for i in range(count):
        words = ["".join(draw.choices("abcdefghij", k=draw.randrange(1, 9))) for _ in range(draw.randrange(3, 60))]
        junk = i % 6 == 0
        if junk:
            words = [w.upper() + "!!" if i % 12 else w + "$$$" for w in words]
        rows.append((i, " ".join(words), int(not junk)))
    return rows


def test_held_out_rows_and_odd_ones(documents, spark):
    rows = corpus(900)
    odd = [(2000, None), (2001, ""), (2002, "WILD!! " * 40_000), (2003, "same"), (2003, "same"), (None, "x y z")]
    docs = documents([r[:2] for r in rows] + odd, extra=True).withColumn("features", F.lit("own")).withColumn("y", F.lit(5))
    labels = [(i, q) for i, _, q in rows] + [(2000, None), (None, 1), (1, 0), (1, 1), (1, 1), (9999, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.learn(docs, labels, held_out=quality.fold(), each=300)
    out = quality.predict(docs.withColumn("held", quality.fold()), model)
    assert out.columns == [c for c in docs.columns if c != "score"] + ["held", "score"]
    got = out.select("doc_id", "text", "held", "score").collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    truth = {i: q for i, _, q in rows}
    held = [(r.score >= 0.5) == (truth[r.doc_id] == 1) for r in got if r.held and r.doc_id in truth]
    assert len(held) > 150 and np.mean(held) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[2000].score == by[2001].score and by[2002].score < 0.5 and by[None].held is False


def test_labels_of_held_out_rows_teach_nothing(documents, spark):
    rows = corpus(200)
    docs = documents([r[:2] for r in rows])
    make = lambda wrong: spark.createDataFrame([(i, 1 - q if wrong and i % 2 else q) for i, _, q in rows], "doc_id long, quality int")
    odd = F.col("doc_id") % 2 == 1
    one, two = (quality.learn(docs, make(w), held_out=odd) for w in (False, True))
    assert one.bias == two.bias and all(np.array_equal(a, b) for a, b in zip(one.tables, two.tables, strict=True))
    none = quality.learn(docs, make(False), held_out=F.lit(True))
    assert {r.score for r in quality.predict(docs, none).collect()} == {0.5}
    assert quality.predict(documents([]), quality.learn(documents([]), make(False))).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op11_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.97
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
