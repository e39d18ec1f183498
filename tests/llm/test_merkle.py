"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from cohortspark.llm import merkle
from cohortspark.llm.queries import QUERIES

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, run):
    """Root, and the digests before and after each leaf on its way there."""
    steps = [[] for _ in nodes]
    now = [(n, [i]) for i, n in enumerate(nodes)]
    while len(now) > 1:
        above = []
        for i in range(0, len(now), run):
            own = now[i : i + run]
            for k, (_, members) in enumerate(own):
                for m in members:
                    steps[m].append(("".join(n for n, _ in own[:k]), "".join(n for n, _ in own[k + 1 :])))
            above.append((sha("".join(n for n, _ in own)), [m for _, members in own for m in members]))
        now = above
    return now[0][0], steps


def plain(rows, run=2):
    """(doc_id, leaf, subroot, root, steps) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    members = [sorted(groups[n], key=lambda m: m[:3]) for n in names]
    trees = [tree([m[2] for m in own], run) for own in members]
    root, tops = tree([t[0] for t in trees], run)
    return [
        (m[3][0], m[2], sub, root, own + top)
        for group, (sub, steps), top in zip(members, trees, tops, strict=True)
        for m, own in zip(group, steps, strict=True)
    ]


def found(docs, **options):
    out = merkle.manifest(docs, merkle.leaf_of(*map(F.col, COLUMNS)), F.col("lang"), F.col("doc_id"), **options)
    got = out.select("doc_id", "merkle.*").collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.proof]) for r in got), key=repr)


@pytest.mark.parametrize(("run", "levels"), [(2, 3), (3, 2), (2, 10)])
def test_against_a_plain_tree(documents, run, levels):
    rows = [(i, f"text {i * 7 % 5}é", ["en", "de", None, "é", "z"][i * i % 5]) for i in range(45)]
    rows += [(None, None, "en"), (None, "b", "en"), (3, None, "lone"), (7, "x" * 50_000, "de"), (7, "", "de"), (8, "same", "en"), (8, "same", "en")]
    docs = documents(rows)
    values = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    assert found(docs, run=run, levels=levels) == sorted(plain(values, run), key=repr)


def test_one_row_and_none(documents):
    one = found(documents([(1, "a", None)]))
    assert [(r[1] == r[2] == r[3], r[4]) for r in one] == [(True, [])]
    assert found(documents([])) == []


def test_columns_stay(documents):
    docs = documents([(1, "a"), (2, "b")], extra=True).withColumn("merkle", F.lit(1)).withColumn("tree", F.lit("t")).withColumn("leaf", F.lit("l"))
    out = merkle.manifest(docs, merkle.leaf_of(F.col("doc_id")), F.col("lang"), F.col("doc_id"))
    assert out.columns == [c for c in docs.columns if c != "merkle"] + ["merkle"]
    assert {(r["tree"], r["leaf"]) for r in out.collect()} == {("t", "l")}
    assert {r.ok for r in out.select((merkle.fold(F.col("merkle.leaf"), F.col("merkle.proof")) == F.col("merkle.root")).alias("ok")).collect()} == {True}


def test_query(spark, tmp_path, documents):
    import zlib

    docs = documents([(i, f"t{i}", ["en", "de"][i % 2]) for i in range(60)] + [(None, "x")])
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") % 9 != 0, F.col("n_chars")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()
    values = {(r[0], leaf(tuple(r))): tuple(r) for r in docs.select(*COLUMNS).collect()}
    want = []
    for doc, own, sub, root, steps in plain(list(values.values())):
        row = list(values[doc, own])
        if doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and row[3] is not None:
            row[3] += 1
        end = leaf(row)
        for before, after in steps:
            end = sha(before + end + after)
        want.append((doc, own, sub, root, sha("".join(b + a for b, a in steps)), end, end == root))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert 0 < sum(r.verified for r in got) < len(got)
