"""Shards and mixes: sizes, orders, targets, hot groups, odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from cohortspark.llm import mixing, sharding

ODD = [(1, None), (2, ""), (3, "x" * 5000), (4, "same"), (5, "same"), (5, "same"), (None, "no id"), (7, "é日本")]


def check_shards(rows, shards, texts):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert all(0 <= k < shards for k in by)
    want = Counter((i, len((t or "").encode()) + 8, None if t is None else zlib.crc32(t.encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def test_shards_of_odd_rows(documents):
    out = sharding.range_shards(documents(ODD, extra=True), 3).collect()
    check_shards(out, 3, ODD)


def test_shards_of_an_empty_table(documents):
    out = sharding.range_shards(documents([]), 4)
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"] and out.count() == 0


def test_shards_are_even_in_bytes_with_a_hot_text(documents):
    rng = random.Random(5)
    rows = [(i, "hot text " * 20 if i % 3 == 0 else "w" * rng.randint(0, 600)) for i in range(3000)]
    out = sharding.range_shards(documents(rows), 8, samples=200, ranges=8).collect()
    check_shards(out, 8, rows)
    sizes = Counter()
    for r in out:
        sizes[r["shard"]] += r["size"]
    mean = sum(sizes.values()) / 8
    assert max(abs(s - mean) for s in sizes.values()) <= 700
    again = sharding.range_shards(documents(rows), 8, samples=200, ranges=8).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_rows_alike_in_all_columns_are_cut(documents):
    rows = [(1, "alike " * 30)] * 900 + [(i, "w" * (i % 50)) for i in range(300)]
    out = sharding.range_shards(documents(rows), 6, samples=300, ranges=8).collect()
    check_shards(out, 6, rows)
    sizes = Counter()
    for r in out:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 400
    again = sharding.range_shards(documents(rows).repartition(3), 6, samples=300, ranges=8).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_places_among_borders():
    from bisect import bisect_right

    import numpy as np

    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 300):
        borders = np.array(sorted(map(tuple, rng.integers(0, 5, (n, 3)).tolist()))).reshape(-1, 3)
        rows = rng.integers(-1, 6, (500, 3))
        got = sharding.places(borders, [rows[:, i] for i in range(3)])
        assert got.tolist() == [bisect_right(list(map(tuple, borders.tolist())), tuple(r)) for r in rows.tolist()]


def test_equal_texts_share_a_shard_unless_cut(documents):
    rows = [(i, f"text {i % 40} " * 10) for i in range(400)]
    shards = defaultdict(set)
    for r in sharding.range_shards(documents(rows), 5).collect():
        shards[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 4


def test_shards_are_written(documents, spark, tmp_path):
    out = sharding.range_shards(documents([(i, "t" * i) for i in range(50)]), 4)
    sharding.write_shards(out, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 4


def targets(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """Brute force: caps sources one round at a time."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > limit * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: limit * sizes[s] for s in full}
        left -= sum(limit * sizes[s] for s in full)
        open_ -= full
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    source = lambda i: "hot" if i % 3 == 0 else rng.choice(["b", "c", "Z", "é", None, "d"])
    return [(i, " ".join(["w"] * rng.randint(0, 80)), "en", source(i)) for i in range(2000)] + [(9999, None, "en", "b")]


def test_mix_meets_its_targets(documents, corpus):
    out = [r.asDict(recursive=True) for r in mixing.mixed(documents(corpus, extra=True)).collect()]
    column = "_mix"
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        m = r[column]
        assert m["size"] == len((r["text"] or "").split(" ")) * bool(r["text"]) and 0 <= m["copies"] <= 2
        sizes[r["source"]] += m["size"]
        taken[r["source"]] += m["size"] * m["copies"]
        target[r["source"]] = m["target"]
    assert len(out) == len(corpus)
    for s, t in targets(sizes).items():
        assert target[s] == pytest.approx(t)
        assert abs(taken[s] - t) <= 80
    again = {(r["doc_id"], r[column]["copies"]) for r in mixing.mixed(documents(corpus, extra=True)).collect()}
    assert again == {(r["doc_id"], r[column]["copies"]) for r in out}


def test_rates_are_an_exponential_tilt(documents, corpus):
    import math

    out = [r.asDict(recursive=True) for r in mixing.mixed(documents(corpus)).collect()]
    for source in {r["source"] for r in out}:
        tilts = {
            round(math.log(r["mix"]["rate"]) / r["mix"]["size"], 6)
            for r in out
            if r["source"] == source and r["mix"]["size"] and 0 < r["mix"]["rate"] < 2
        }
        assert len(tilts) <= 1


def test_mix_of_nothing(documents):
    assert mixing.mixed(documents([])).count() == 0
    out = mixing.mixed(documents([(1, None), (2, ""), (2, "")])).collect()
    assert [r["mix"]["copies"] for r in out] == [1, 1, 1]


def test_mix_of_rows_without_id_and_of_long_texts(documents):
    rows = [(None, "a b", "en", "x"), (None, "a b", "en", "x"), (None, None, "en", None), (1, "w " * 150_000, "en", "x"), (2, "w " * 149_000, "en", "y")]
    rows += [(10 + i, "w " * (i % 90), "en", "xy"[i % 2]) for i in range(400)]
    out = [r.asDict(recursive=True) for r in mixing.mixed(documents(rows)).collect()]
    assert len(out) == len(rows)
    assert sorted(r["mix"]["size"] for r in out if r["doc_id"] in (1, 2)) == [149_000, 150_000]
    alike = [r["mix"]["copies"] for r in out if r["doc_id"] is None and r["text"]]
    assert alike[0] == alike[1]
    assert all(0 <= r["mix"]["copies"] <= 2 for r in out)


def test_mix_rows_are_repeated(documents):
    docs = documents([(i, "a b c", "en", s) for i, s in enumerate("abcabcabc")])
    mix = mixing.mixed(docs)
    rows = mixing.repeated(mix)
    assert rows.columns == docs.columns
    assert rows.count() == sum(r["mix"]["copies"] for r in mix.collect())
