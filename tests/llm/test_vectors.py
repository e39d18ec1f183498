"""Near-duplicate vectors and nearest neighbours against brute force."""

from __future__ import annotations

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import graphs_search, lattice

ODD = [(900, None, 1), (901, [0.0] * 16, 1), (902, [None] + [1.0] * 15, 1), (903, [float("nan")] * 16, 1), (904, [float("inf")] * 16, 1), (905, [1.0, 2.0], 1), (906, [], 2)]


def cloud(seed, n, spread=0.02):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    centre = rng.standard_normal((n // 10, 16))
    for c in centre:
        for _ in range(int(rng.integers(1, 8))):
            rows.append((i, (c + spread * rng.standard_normal(16)).astype(np.float32).tolist(), int(rng.integers(0, 2))))
            i += 1
    for _ in range(40):  # a hot group
        rows.append((i, (centre[0] + spread * rng.standard_normal(16)).astype(np.float32).tolist(), 0))
        i += 1
    rows += [(i + k, rows[5][1], rows[5][2]) for k in range(3)]  # equal vectors
    return rows


def brute(rows, cosine=0.93):
    ok = [(i, np.array(v, float), c) for i, v, c in rows if c is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i, _, _ in rows}
    for a, (i, x, c) in enumerate(ok):
        for j, y, d in ok[:a]:
            if c == d and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[i].add(j)
                links[j].add(i)
    root = {}
    for i in sorted(links):
        if i in root:
            continue
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in root:
                root[k] = i
                todo += links[k]
    return sorted((i, len(links[i]), root[i], root[i] == i) for i in links)


def test_e8_points_are_lattice_points():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, 8)) * 2
    best, other = lattice.e8_points(x)
    for p in (best, other):
        whole = (p % 2 == 0).all(1) | (p % 2 != 0).all(1)
        assert whole.all() and (p.sum(1) % 4 == 0).all()
    assert ((best != other).any(1)).all()
    # no lattice point lies farther from its place than the covering radius, and no neighbour is nearer
    gap = ((best / 2 - x) ** 2).sum(1)
    assert gap.max() <= 1 + 1e-9 and (gap <= ((other / 2 - x) ** 2).sum(1) + 1e-12).all()
    steps = [np.eye(8)[i] * a + np.eye(8)[j] * b for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)]
    for s in steps:
        assert (gap <= ((best / 2 + s - x) ** 2).sum(1) + 1e-9).all()


@pytest.mark.parametrize(("block_rows", "many", "bin_bytes"), [(512, 1 << 14, 8 << 20), (8, 4, 20_000), (8, 1 << 14, 20_000)])
def test_links_are_those_of_brute_force(vectors, block_rows, many, bin_bytes, monkeypatch):
    monkeypatch.setattr(lattice, "MANY", many)
    monkeypatch.setattr(lattice, "BIN_BYTES", bin_bytes)
    rows = cloud(3, 120) + ODD + [(950, [1.0] * 16, None), (951, [1.0] * 16, None)]
    out = lattice.near_duplicates(vectors(rows), tables=16, scale=0.8, block_rows=block_rows).collect()
    assert sorted(map(tuple, out)) == brute(rows)


@pytest.mark.parametrize("dim", [64, 128])
def test_registered_tables_find_the_links(dim):
    """Share of pairs at some cosine that meet in a cell, with the parameters of the query."""
    options = {k: p.default for k, p in inspect.signature(lattice.near_duplicates).parameters.items()}
    rng = np.random.default_rng(dim)
    made = lattice.Tables(dim, options["tables"], options["blocks"], options["scale"], options["seed"])
    x, y = rng.standard_normal((2, 3000, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    for cosine in (0.93, 0.95, 0.99):
        z = cosine * x + np.sqrt(1 - cosine**2) * y
        a, b = made.keys(x), made.keys(z)
        meets = (a[:, :, :1] == b).any(2) | (a == b[:, :, :1]).any(2)
        assert meets.any(1).mean() >= 0.99


def test_no_vectors(vectors):
    out = lattice.near_duplicates(vectors([]))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"] and out.count() == 0
    assert graphs_search.nearest(vectors([]), F.lit(True)).count() == 0


def test_repeated_ids_each_have_a_row(vectors):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (None, [0.0, 1.0], 1)]
    out = sorted((tuple(r) for r in lattice.near_duplicates(vectors(rows)).collect()), key=str)
    assert out == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 2, True), (None, 1, 2, False)], key=str)


@pytest.mark.parametrize("shard_rows", [100, 5000])
def test_recall_and_scores(vectors, shard_rows):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(2000 + i, rows[0][1], 0) for i in range(60)] + ODD
    out = graphs_search.nearest(vectors(rows), F.col("vec_id") % 100 == 0, count=20, shard_rows=shard_rows).collect()
    good = [(i, np.array(v, float)) for i, v, _ in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, m = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    by = {}
    for r in out:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == {i for i in ids.tolist() if i % 100 == 0}
    hits = total = 0
    for q, got in by.items():
        scores = m @ m[ids == q][0]
        want = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != q)[:20]
        got.sort()
        assert [r for r, _, _ in got] == list(range(1, 21))
        assert all(s == pytest.approx(float(m[ids == i][0] @ m[ids == q][0]), abs=1e-12) for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        hits += len({i for _, i, _ in got} & {i for _, i in want})
        total += 20
    assert hits / total >= 0.95
    # ties among equal vectors go to the smallest ids
    assert [i for _, i, _ in by[0][:19]] == list(range(2000, 2019))


def true_nearest(x, queries, count=20):
    near = x[queries] @ x.T
    near[np.arange(len(queries)), queries] = -np.inf
    return np.argsort(-near, axis=1)[:, :count]


def recall(vectors, x):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = {}
    for r in graphs_search.nearest(vectors(rows), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    queries = np.arange(0, len(x), 50)
    want = true_nearest(x.astype(np.float32).astype(float), queries)
    return np.mean([len(got[q] & set(w)) / 20 for q, w in zip(queries.tolist(), want.tolist(), strict=True)])


@pytest.mark.parametrize("case", ["equal", "unequal", "very unequal", "one far longer"])
def test_recall_on_a_whole_shard(vectors, case):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((8192, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    spread = {"equal": 0, "unequal": 0.5, "very unequal": 1, "one far longer": 0}[case]
    x *= np.exp(spread * rng.standard_normal(len(x)))[:, None]
    if case == "one far longer":
        x[7] *= 10_000
    assert recall(vectors, x) >= 0.97


def test_links_of_close_vectors_far_from_zero():
    rng = np.random.default_rng(4)
    x = 1e-5 * rng.standard_normal((500, 16)) + 1
    graph = graphs_search.build(x, 20, 64)
    squares = (x**2).sum(1)
    x = np.column_stack([x, np.sqrt(squares.max() - squares)])
    gap = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(gap, np.inf)
    assert np.mean([gap[i].argmin() in graph.layers[0].neighbours[i] for i in range(len(x))]) >= 0.99


def test_few_candidates(vectors):
    rows = [(20, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [3.0, 0.0], 0), (40, [0.0, 0.0], 0), (60, None, 0)]
    out = [tuple(r) for r in graphs_search.nearest(vectors(rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert out == [(20, 1, 2, 3.0), (20, 2, 1, 0.5)]


@pytest.mark.parametrize("shard_rows", [40, 5000])
def test_ids_of_many_vectors_take_one_place(vectors, shard_rows):
    rng = np.random.default_rng(12)
    turn = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [(20, turn(0), 0)] + [(i, turn(a), 0) for i in (20, 1, 2) for a in rng.uniform(0.001, 0.3, 150)]
    rows += [(100 + i, turn(0.4 + i / 100), 0) for i in range(41, 79)]
    out = graphs_search.nearest(vectors(rows), F.col("vec_id") == 20, shard_rows=shard_rows).where("score is not null")
    got = {}
    for r in out.collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert len(got[20]) == 20 * 151 and {i for i in got[20]} >= {1, 2, 141}
