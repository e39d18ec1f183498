"""Jaccard groups and repeated passages against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import jaccard, repeats
from cohortspark.llm.common import Scratch
from cohortspark.llm.graph import components, local_roots

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, width=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_groups(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), least.get(find(i), doc)) for i, (doc, _) in enumerate(rows)), key=str)


def corpus(seed, common=True):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    rows, passage = [], " ".join(word() for _ in range(40))
    for _ in range(60):
        rows.append(" ".join(word() for _ in range(rng.randint(1, 120))))
    base = [word() for _ in range(100)]
    for _ in range(100):  # a large group of near copies, some of them too far apart
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(len(own))] = word()
        rows.append(" ".join(own))
    for _ in range(40):
        text = rng.choice(rows).split(" ")
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = word()
        rows.append(" ".join(text).upper() if rng.random() < 0.2 else " ".join(text))
    if common:
        rows += [passage + " " + " ".join(word() for _ in range(rng.randint(0, 90))) for _ in range(60)]
    rows += rows[:10]
    rng.shuffle(rows)
    return list(enumerate(rows))


ODD = [(900, None), (901, ""), (902, " \t"), (903, "One two"), (904, "one  TWO"), (905, "one two three"), (903, "One two"), (None, "one two"), (None, "lonely text")]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_are_those_of_brute_force(documents, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 8)  # combinations are exercised on a small corpus
    rows = corpus(seed) + ODD
    out = jaccard.similar_groups(documents(rows, extra=True)).collect()
    assert sorted(map(tuple, out), key=str) == brute_groups(rows)


def test_groups_among_many_changed_copies(documents, monkeypatch):
    """Copies of two texts around the threshold, which share hundreds of keys and link in part only."""
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    rows, passage = [], [word() for _ in range(60)]
    for text in ([word() for _ in range(400)], [word() for _ in range(90)] + passage):
        for i in range(90):
            copy = list(text)
            for _ in range(rng.randint(0, len(text) // 22)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [" ".join(passage + [word() for _ in range(rng.randint(0, 25))]) for _ in range(60)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    want = brute_groups(rows)
    assert 5 < len({r[2] for r in want}) < 200
    assert sorted(map(tuple, jaccard.similar_groups(documents(rows)).collect()), key=str) == want


def test_copies_too_far_from_each_other_do_not_meet(documents, monkeypatch):
    """Copies of one text, each changed a lot, share hundreds of keys; bounds on them leave few pairs."""
    monkeypatch.setattr(jaccard, "FREQUENT", 4)
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    text, rows, met = [word() for _ in range(400)], [], []
    for _ in range(90):
        copy = list(text)
        for at in rng.sample(range(400), 10):
            copy[at] = word()
        rows.append(" ".join(copy))
    rows = list(enumerate([*rows, *rows[:3], " ".join(text)]))
    keep = Scratch.keep

    def kept(work, df):
        out = keep(work, df)
        if df.columns == ["root", "to"]:
            met.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "keep", kept)
    got = sorted(map(tuple, jaccard.similar_groups(documents(rows)).collect()), key=str)
    assert got == brute_groups(rows)
    assert len(met) == 1 and met[0] < 90, met


def test_component_bounds_rule_out_no_similar_sets(spark):
    """Components of sets around one text: where any two sets are similar, the bounds let them meet."""
    rng, rule = np.random.default_rng(5), jaccard.Rule(80)
    text, groups = rng.integers(1, 1 << 62, 120, dtype=np.uint64), []
    for _ in range(40):
        near = np.concatenate([rng.permutation(text)[: 120 - rng.integers(0, 30)], rng.integers(1, 1 << 62, rng.integers(0, 12), dtype=np.uint64)])
        groups.append([np.unique(rng.permutation(near)[: len(near) - rng.integers(0, 4)]) for _ in range(rng.integers(1, 4))])
    count = dict(zip(*np.unique(np.concatenate([x for g in groups for x in g]), return_counts=True), strict=True))

    def bounds(g):
        sketches = np.array([jaccard.sketch(x) for x in g])
        reach = max(180 * sum(count[t] > 1 for t in x.tolist()) - 80 * len(x) for x in g)
        return [min(map(len, g)), max(map(len, g)), reach, *np.bitwise_and.reduce(sketches).tolist(), *np.bitwise_or.reduce(sketches).tolist()]

    names = ["n_least", "n_most", "reach", *(f"all_{w}" for w in jaccard._WORDS), *(f"any_{w}" for w in jaccard._WORDS)]
    one = spark.createDataFrame([(i, *map(int, bounds(g))) for i, g in enumerate(groups)], ["i", *names])
    other = one.select(*(F.col(c).alias(f"to_{c}") for c in one.columns))
    left = {(r.i, r.to_i) for r in one.crossJoin(other).where("i < to_i").where(jaccard._may_link(rule)).collect()}
    similar = {
        (i, j) for j in range(40) for i in range(j)
        if any(rule.similar(len(x), len(y), len(np.intersect1d(x, y))) for x in groups[i] for y in groups[j])
    }
    assert 0 < len(similar) and similar <= left and len(left) < 780


def test_long_texts_are_grouped_whole(documents):
    rng = random.Random(13)
    long = ["w%d" % rng.randrange(50_000) for _ in range(40_000)]
    near, far = list(long), list(long)
    for i in range(0, 40_000, 60):
        near[i] = "x%d" % i  # changes 8 shingles in 100
    for i in range(20_000, 40_000, 5):
        far[i] = "y%d" % i  # the second half alone
    rows = [(i, " ".join(t)) for i, t in enumerate([long, near, far])]
    got = {r.doc_id: r.component_id for r in jaccard.similar_groups(documents(rows)).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_no_table_is_left_behind(spark, documents):
    before = {r.tableName for r in spark.sql("SHOW TABLES").collect()}
    jaccard.similar_groups(documents(list(enumerate(["a b c d e f g"] * 3)))).count()
    assert {r.tableName for r in spark.sql("SHOW TABLES").collect()} == before


def test_groups_of_nothing(documents):
    out = jaccard.similar_groups(documents([]))
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(4)
    rule = jaccard.Rule(80)
    for n in (4, 5, 9, 30, 64, 79, 81, 130, 400):
        for often in (3, 200):
            for _ in range(30):
                a = rng.integers(1, 1 << 62, n, dtype=np.uint64)
                spare = int(n / 9)
                b = np.concatenate([a[: n - spare], rng.integers(1, 1 << 62, spare, dtype=np.uint64)])
                a, b = np.unique(a), np.unique(b)
                if not rule.similar(len(a), len(b), len(np.intersect1d(a, b))):
                    continue
                shared = set(np.intersect1d(a, b).tolist())
                times = [np.array([often if t in shared else 1 for t in x.tolist()], np.uint8) for x in (a, b)]
                keys = [set(jaccard.keys_of(x, t, rule).tolist()) for x, t in zip((a, b), times, strict=True)]
                assert keys[0] & keys[1]


def test_sketches_differ_in_no_more_bits_than_sets_in_tokens():
    rng = np.random.default_rng(5)
    for n, m in ((10, 3), (300, 40), (2000, 700)):
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.concatenate([a[m:], np.unique(rng.integers(0, 1 << 62, m // 2 + 1, dtype=np.uint64))])
        bits = sum(int(x).bit_count() for x in (jaccard.sketch(a) ^ jaccard.sketch(b)).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def brute_repeats(rows, width=100):
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        raw = (rows[i][1] or "").encode()
        covered = np.zeros(len(raw), bool)
        for p in range(len(raw) - width + 1):
            w = raw[p : p + width]
            if w in seen:
                covered[p : p + width] = True
            seen.add(w)
        runs = int((covered & ~np.concatenate([[False], covered[:-1]])).sum()) if len(raw) else 0
        kept = np.frombuffer(raw, np.uint8)[~covered].tobytes()
        out[rows[i][0]] = (len(raw), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeats_of(docs):
    out = repeats.repeated_spans(docs)
    size = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["size"]), F.lit(0).cast("long"))
    kept = F.sha2(repeats.kept_bytes(F.col("text"), F.col("spans")), 256)
    rows = out.select("doc_id", "n_bytes", size, F.size(F.coalesce("spans", F.array())), kept).collect()
    return rows


@pytest.mark.parametrize(("seed", "fan"), [(1, 1000), (2, 2), (3, 3)])
def test_repeats_are_those_of_brute_force(documents, seed, fan, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 4000)
    monkeypatch.setattr(repeats, "PART_BYTES", 2000)
    monkeypatch.setattr(repeats, "HOT", 5)
    monkeypatch.setattr(repeats, "FAN", fan)
    rng = random.Random(seed)
    letters = "abcdé "
    text = lambda n: "".join(rng.choices(letters, k=n))
    passages = [text(rng.randint(60, 400)) for _ in range(6)] + ["é" * 150, "ab" * 90, "x" * 250]
    rows = []
    for i in range(120):
        parts = [text(rng.randint(0, 200)), rng.choice(passages), text(rng.randint(0, 80)), rng.choice(passages)]
        rows.append((i, "".join(rng.sample(parts, rng.randint(1, 4)))))
    rows += [(200, rows[3][1]), (-5, rows[4][1]), (201, None), (202, ""), (203, "y" * 99), (204, "y" * 100), (205, "y" * 101), (None, "no id " * 40), (206, "z" * 3000)]
    rows.append((207, "".join(rng.choices(letters, k=60_000)) + passages[0] + "long " * 40_000))
    got = {r[0]: tuple(r[1:]) for r in repeats_of(documents(rows, extra=True))}
    assert got == brute_repeats(rows)


def test_rows_alike_get_equal_results(documents):
    rows = [(1, "q" * 99 + "r"), (1, "q" * 99 + "r"), (2, "q" * 99 + "r" + "tail"), (2, "q" * 99 + "r" + "tail")]
    out = sorted(tuple(r[:4]) for r in repeats_of(documents(rows)))
    assert out == [(1, 100, 0, 0), (1, 100, 0, 0), (2, 104, 100, 1), (2, 104, 100, 1)]
    assert repeats_of(documents([])) == []


def test_cut_text_has_whole_characters(documents, spark):
    span = "array(named_struct('start', 1L, 'size', 2L))"
    rows = spark.createDataFrame([("éé",), ("aéb",), ("aaa",)], "text string").withColumn("spans", F.expr(span))
    assert [r[0] for r in rows.select(repeats.kept_text(F.col("text"), F.col("spans"))).collect()] == ["", "ab", "a"]


def test_cuts_take_time_in_proportion(spark):
    """Sixteen times the text with sixteen times the spans; a quadratic cut takes 256 times as long."""
    import time

    def seconds(spans):
        rows = spark.range(1).select(F.repeat(F.lit("0123456789é" * 20), spans).alias("text"))
        where = F.transform(F.sequence(F.lit(0), F.lit(spans - 1)), lambda i: F.struct((i * 240 + 11).cast("long").alias("start"), F.lit(100).cast("long").alias("size")))
        rows = rows.select("text", where.alias("spans"))
        begin = time.perf_counter()
        kept = rows.select(F.length(repeats.kept_text(F.col("text"), F.col("spans"))), F.octet_length(repeats.kept_bytes(F.col("text"), F.col("spans")))).first()
        assert kept[1] == 140 * spans and kept[0] <= 128 * spans
        return time.perf_counter() - begin

    seconds(400)
    small = min(seconds(400) for _ in range(3))
    assert min(seconds(6400) for _ in range(3)) < 60 * small


def test_merge_orders_like_a_sort():
    """The interleave of two transforms is that of the sorted union of their suffixes."""
    rng = np.random.default_rng(8)
    shards = []
    for _ in range(3):
        symbol = rng.integers(1, 4, 60)
        symbol[-1] = 0
        shards.append((symbol, np.roll(np.arange(60), 1)))
    rounds = 5
    orders = [repeats.transform(s, b, rounds) for s, b in shards]
    interleave, intervals = repeats.merge([s[b[o]] for (s, b), o in zip(shards, orders, strict=True)], rounds)
    prefix = lambda s, i: tuple(s[(i + k) % 60] for k in range(rounds))
    want = sorted((prefix(s, i), n) for n, (s, _) in enumerate(shards) for i in range(60))
    assert interleave.tolist() == [n for _, n in want]
    number = {p: k for k, p in enumerate(sorted({p for p, _ in want}))}
    for n, ((s, _), o) in enumerate(zip(shards, orders, strict=True)):
        assert intervals[n].tolist() == [number[prefix(s, i)] for i in o]


@pytest.mark.parametrize("width", [1, 2, 3, 20, 32, 69, 100])
def test_rolled_hashes_and_sliding_minima(width):
    rng = np.random.default_rng(width)
    data = rng.integers(0, 3, 400, dtype=np.uint8)
    got = repeats.rolled(data, width)
    whole = [data[i : i + width].tobytes() for i in range(400 - width + 1)]
    assert len(set(zip(whole, got[: len(whole)].tolist(), strict=True))) == len(set(whole)) == len(set(got[: len(whole)].tolist()))
    values = rng.integers(0, 1000, 300, dtype=np.uint64)
    low = repeats._sliding(values, width, np.minimum)
    assert low[: 300 - width + 1].tolist() == [values[i : i + width].min() for i in range(300 - width + 1)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    out = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    got = {r["node"]: r["root"] for r in out.collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200}
    assert local_roots(6, np.array([5, 4, 1]), np.array([4, 2, 0])).tolist() == [0, 0, 2, 3, 2, 2]


def test_lower_similarities_find_small_sets_and_sets_of_unequal_sizes(documents):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, "a b"), (2, "a b c"), (3, " ".join(words[:31])), (4, " ".join(words[:50])), (5, "d e"), (6, "e f g")]
    out = jaccard.similar_groups(documents(rows), width=1, percent=60)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6}
    with pytest.raises(ValueError):
        jaccard.Rule(50)
