"""Nearest neighbours by inner product with a navigable small-world graph for each shard.

A shard's graph has layers: every vector is in layer 0, and each layer holds a hashed part of the
one below. A layer is a flat array with a fixed number of neighbours for each vector. A shard holds
vectors of near equal lengths: among very unequal ones the longest, which every query wants, lie
scattered in the graph and are missed. Vectors get one more component that makes their lengths equal,
so that the nearest by distance has the largest inner product. A search goes down greedily from the
top layer and widens in layer 0. Shards are searched one by one, and their results merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import Scratch, mixed
from cohortspark.llm.lattice import usable


#: vectors whose lengths' logarithms round to the same multiple of this share shards
BAND = 0.05


class Layer:
    """Nodes of a layer, and neighbours[place of a node, slot] as nodes of layer 0 (-1: none)."""

    def __init__(self, nodes: np.ndarray, neighbours: np.ndarray):
        self.nodes, self.neighbours = nodes, neighbours


class Graph:
    def __init__(self, vectors: np.ndarray, layers: list[Layer]):
        """``layers`` from layer 0 up; ``vectors`` with the component that evens lengths."""
        self.vectors, self.layers = vectors, layers
        self.place = []
        for layer in layers:
            at = np.full(len(vectors), -1, np.int64)
            at[layer.nodes] = np.arange(len(layer.nodes))
            self.place.append(at)


def bands(vectors: np.ndarray) -> np.ndarray:
    """Which range of lengths each vector is in; no length overflows."""
    most = np.abs(vectors).max(1)
    length = np.log(most) + np.log(((vectors / most[:, None]) ** 2).sum(1)) / 2
    return np.floor(length / BAND + 0.5).astype(np.int64)


def evened(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the largest component of all, with the one that evens lengths."""
    vectors = vectors / max(np.abs(vectors).max(initial=0), np.finfo(float).tiny)
    squares = (vectors**2).sum(1)
    last = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    return np.column_stack([vectors, last])


def build(vectors: np.ndarray, degree: int = 16, wide: int = 64) -> Graph:
    """The graph of a shard's vectors (in rows).

    A node's candidates are the ``wide`` nearest of its layer, found by blocks of products within the
    shard, in double precision around the middle, so that close vectors far from zero do not tie; a candidate nearer to a chosen neighbour than to the node is passed over while others are
    left. Links are made in both directions and cut to the nearest again.
    """
    x = evened(vectors)
    n = len(x)
    centred = x - x.mean(0)
    chance = (mixed(np.arange(n, dtype=np.uint64) + np.uint64(1)) >> np.uint64(11)).astype(float) / (1 << 53)
    level = np.floor(-np.log(np.maximum(chance, 1e-300)) / math.log(degree)).astype(np.int64)
    layers = []
    for k in range(int(level.max()) + 1 if n else 0):
        nodes = np.flatnonzero(level >= k)
        layers.append(Layer(nodes, nodes_or_none(nodes, _links(centred[nodes], 2 * degree if k == 0 else degree, wide))))
    return Graph(x, layers)


def nodes_or_none(nodes: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.where(places < 0, -1, nodes[places]).astype(np.int32)


def _links(x: np.ndarray, degree: int, wide: int) -> np.ndarray:
    n = len(x)
    take = min(wide, n - 1)
    if take < 1:
        return np.full((n, degree), -1)
    chosen = np.full((n, degree), -1)
    half = (x**2).sum(1) / 2  # likeness: a product less both halves, so less half the squared distance
    for begin in range(0, n, 512):
        rows = np.arange(begin, min(begin + 512, n))
        near = x[rows] @ x.T - half[rows, None] - half
        near[np.arange(len(rows)), rows] = -np.inf
        part = np.argpartition(-near, take - 1, axis=1)[:, :take]
        value = np.take_along_axis(near, part, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        part, value = np.take_along_axis(part, order, 1), np.take_along_axis(value, order, 1)
        among = np.matmul(x[part], x[part].transpose(0, 2, 1)) - half[part][:, :, None] - half[part][:, None]
        picked = np.zeros(part.shape, bool)
        blocked = np.full(part.shape, -np.inf)  # likeness to the nearest chosen one
        for c in range(take):
            ok = (value[:, c] >= blocked[:, c]) & (picked.sum(1) < degree // 2)
            picked[:, c] = ok
            blocked = np.where(ok[:, None], np.maximum(blocked, among[:, c]), blocked)
        # chosen ones first, then the nearest of the others
        rank = np.argsort(np.where(picked, 0, 1) * take + np.arange(take), axis=1)
        best = np.take_along_axis(part, rank, 1)[:, :degree]
        room = max(picked.sum(1).max(), degree // 2)
        chosen[rows[:, None], np.arange(min(room, best.shape[1]))] = best[:, :room]
    # both directions, the nearest first, chosen links before those of the other side
    a = np.repeat(np.arange(n), degree)
    b = chosen.ravel()
    keep = b >= 0
    a, b = a[keep], b[keep]
    pairs = np.concatenate([a * n + b, b * n + a])
    own = np.repeat([0, 1], len(a))
    pairs, first = np.unique(pairs, return_index=True)
    own = own[first]
    a, b = pairs // n, pairs % n
    like = np.concatenate([np.einsum("rd,rd->r", x[a[i : i + 65536]], x[b[i : i + 65536]]) for i in range(0, len(a), 65536)]) - half[a] - half[b]
    order = np.lexsort((-like, own, a))
    a, b = a[order], b[order]
    slot = np.arange(len(a)) - np.searchsorted(a, a)
    out = np.full((n, degree), -1)
    fits = slot < degree
    out[a[fits], slot[fits]] = b[fits]
    return out


def search(graph: Graph, queries: np.ndarray, count: int, beam: int = 128, step: int = 4) -> np.ndarray:
    """Nodes with the largest inner products found for each query, best first (-1: none)."""
    n = len(graph.vectors)
    q = np.column_stack([queries / np.maximum(np.abs(queries).max(1, keepdims=True, initial=0), np.finfo(float).tiny), np.zeros(len(queries))])
    if not n or not len(q):
        return np.full((len(q), count), -1)
    at = np.full(len(q), graph.layers[-1].nodes[0])
    for layer, place in zip(graph.layers[:0:-1], graph.place[:0:-1], strict=True):
        value = np.einsum("rd,rd->r", q, graph.vectors[at])
        moving = np.arange(len(q))
        while len(moving):
            near = layer.neighbours[place[at[moving]]]
            likes = np.einsum("rd,rkd->rk", q[moving], graph.vectors[near])
            likes[near < 0] = -np.inf
            best = likes.argmax(1)
            like = likes[np.arange(len(moving)), best]
            better = like > value[moving]
            moving_to, moving = near[np.arange(len(moving)), best][better], moving[better]
            at[moving], value[moving] = moving_to, like[better]
    return _widen(graph, q, at, max(count, beam), step)[:, :count]


def _widen(graph: Graph, q: np.ndarray, start: np.ndarray, beam: int, step: int) -> np.ndarray:
    """Best-first search of layer 0 for all queries side by side, ``step`` nodes of each at a time."""
    links, x, n = graph.layers[0].neighbours, graph.vectors, len(graph.vectors)
    rows = np.arange(len(q))
    seen = np.zeros((len(q), n + 1), bool)
    seen[:, n] = True  # stands for "no neighbour"
    seen[rows, start] = True
    found = np.full((len(q), beam), n)
    like = np.full((len(q), beam), -np.inf)
    open_ = np.zeros((len(q), beam), bool)
    found[:, 0], like[:, 0], open_[:, 0] = start, np.einsum("rd,rd->r", q, x[start]), True
    while len(live := np.flatnonzero(open_.any(1))):
        f, v, o = found[live], like[live], open_[live]
        pick = np.argsort(np.where(o, -v, np.inf), axis=1, kind="stable")[:, :step]
        usable_ = np.take_along_axis(o, pick, 1)
        nodes = np.where(usable_, np.take_along_axis(f, pick, 1), n)
        np.put_along_axis(o, pick, False, 1)
        near = np.where(nodes[..., None] < n, links[np.minimum(nodes, n - 1)], -1).reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[seen[live[:, None], near]] = n
        seen[live[:, None], near] = True
        likes = np.einsum("rd,rkd->rk", q[live], x[np.minimum(near, n - 1)], optimize=True)
        likes[near == n] = -np.inf
        f, v = np.concatenate([f, near], 1), np.concatenate([v, likes], 1)
        o = np.concatenate([o, near < n], 1)
        best = np.argpartition(-v, beam - 1, axis=1)[:, :beam]
        found[live], like[live] = np.take_along_axis(f, best, 1), np.take_along_axis(v, best, 1)
        open_[live] = np.take_along_axis(o, best, 1)
    order = np.argsort(-like, axis=1, kind="stable")
    found = np.take_along_axis(found, order, 1)
    return np.where(found == n, -1, found)


def _rows(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """id and vector, as bytes of doubles, of the rows that take part."""
    values = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))  # one zero
    rows = vectors.where(usable(vector) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
            vec = pa.array([flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), vec], ["vec_id", "vec"])

    return rows.mapInArrow(pack, "vec_id bigint, vec binary")


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with their ``keep`` smallest ids; each task hands on no more of a vector."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: dict[bytes, list[int]] = {}
            for v, i in zip(batch.column("vec").to_pylist(), batch.column("vec_id").to_pylist(), strict=True):
                ids.setdefault(v, []).append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(ids), pa.binary()), pa.array([sorted(set(i))[:keep] for i in ids.values()], pa.list_(pa.int64()))], ["vec", "ids"]
            )

    some = rows.mapInArrow(least, "vec binary, ids array<bigint>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return some.groupBy("vec").agg(ids.alias("ids"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows)).reshape(len(rows), -1)


INDEX = "shard int, dim int, vectors binary, sizes array<int>, ids array<bigint>, nodes array<binary>, neighbours array<binary>"


def _banded(classes: DataFrame) -> DataFrame:
    """``classes`` with the number of components and the range of lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column("vec").to_pylist()
            dim = np.array([len(v) // 8 for v in vec], np.int32)
            band = np.zeros(len(vec), np.int64)
            for d in np.unique(dim).tolist():
                at = np.flatnonzero(dim == d)
                band[at] = bands(np.frombuffer(b"".join(vec[i] for i in at)).reshape(len(at), d))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dim), pa.array(band.astype(np.int32))], [*batch.schema.names, "dim", "band"])

    return classes.mapInArrow(run, "vec binary, ids array<bigint>, dim int, band int")


def _ranges(classes: DataFrame, shard_rows: int) -> DataFrame:
    """The shards of each length and range of lengths: their number and the first one's."""
    sizes = sorted(map(tuple, classes.groupBy("dim", "band").count().collect()))
    rows, first = [], 0
    for dim, band, n in sizes:
        rows.append((dim, band, first, math.ceil(n / shard_rows)))
        first += rows[-1][-1]
    return classes.sparkSession.createDataFrame(rows, "dim int, band int, first int, shards int")


def build_index(classes: DataFrame, ranges: DataFrame, degree: int, wide: int) -> DataFrame:
    """One row for each shard: vectors, ids, and the layers as flat arrays."""

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec")
        x = _matrix(table.column("vec"))
        graph = build(x, degree, wide)
        ids = table.column("ids").to_pylist()
        row = {
            "shard": table.column("shard")[0].as_py(),
            "dim": table.column("dim")[0].as_py(),
            "vectors": x.tobytes(),
            "sizes": [len(i) for i in ids],
            "ids": [j for i in ids for j in i],
            "nodes": [layer.nodes.astype(np.int64).tobytes() for layer in graph.layers],
            "neighbours": [layer.neighbours.tobytes() for layer in graph.layers],
        }
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary())]
        return pa.table({k: pa.array([v], t) for (k, v), t in zip(row.items(), kinds, strict=True)})

    placed = classes.join(F.broadcast(ranges), ["dim", "band"])
    shard = F.col("first") + F.pmod(F.xxhash64("vec"), F.col("shards")).cast("int")
    return placed.select("vec", "ids", "dim", shard.alias("shard")).groupBy("shard", "dim").applyInArrow(one, INDEX)


def load_index(row: dict) -> tuple[np.ndarray, list[np.ndarray], Graph]:
    x = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
    ids = np.split(np.array(row["ids"], np.int64), np.cumsum(row["sizes"])[:-1])
    layers = []
    for nodes, neighbours in zip(row["nodes"], row["neighbours"], strict=True):
        nodes = np.frombuffer(nodes, np.int64)
        layers.append(Layer(nodes, np.frombuffer(neighbours, np.int32).reshape(len(nodes), -1)))
    return x, ids, Graph(evened(x), layers)


def _best(x: np.ndarray, ids: list[np.ndarray], query: np.ndarray, nodes: np.ndarray, count: int) -> dict[int, float]:
    """The best score of each id, from as few of the nodes (best first) as give ``count`` ids."""
    take = count
    while True:
        some, best = nodes[:take], {}
        for node, score in zip(some.tolist(), (x[some] @ query).tolist(), strict=True):
            for i in ids[node].tolist():
                if i not in best or score > best[i]:
                    best[i] = score
        if len(best) >= count or take >= len(nodes):
            return best
        take *= 2


def nearest(
    vectors: DataFrame, queries: F.Column, vec_id: str = "vec_id", vector: str = "embedding", count: int = 20,
    shard_rows: int = 8192, query_rows: int = 4096, degree: int = 20, wide: int = 64, beam: int = 128,
) -> DataFrame:
    """The ``count`` nearest rows found for each row that ``queries`` (a condition on vec_id) picks.

    Returns query_id, rank (from 1), vec_id, score: the inner product in double precision, largest
    first, ties to the smaller vec_id; the query's own id is never among them. Vectors that are null,
    zero or hold null or non-finite components, and rows without an id, take no part. Vectors are
    compared with those of the same length only. Equal vectors are one node that knows its smallest
    ids, more than any result needs; a vec_id with several vectors is found by the nearest.

    All rows are indexed: ranges of lengths, 5 hundredths wide, are hashed to shards of about
    ``shard_rows`` distinct vectors, so there are the more shards the more data. Distinct query vectors go in blocks of ``query_rows`` to each shard.
    """
    spark = vectors.sparkSession
    work = Scratch(spark, "search")
    rows = work.keep(_rows(vectors, vec_id, vector).withColumn("query", F.unhex(F.md5("vec"))))
    classes = work.keep(_banded(_classes(rows.select("vec_id", "vec"), count + 1)))
    ranges = _ranges(classes, shard_rows)
    index = work.keep(build_index(classes, ranges, degree, wide))
    asked = rows.where(queries)
    wanted = work.keep(asked.select("query", "vec").distinct())
    blocks = max(1, math.ceil(wanted.count() / query_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    shards = ranges.select("dim", F.explode(F.sequence("first", F.col("first") + F.col("shards") - 1)).alias("shard"))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block")
    sent = wanted.select("query", "vec", (F.octet_length("vec") / 8).cast("int").alias("dim"), block).join(F.broadcast(shards), "dim")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            x, ids, graph = load_index(right.to_pylist()[0])
            names, q = left.column("query").to_pylist(), _matrix(left.column("vec"))
            for begin in range(0, len(q), 256):
                waiting, width = list(range(begin, min(begin + 256, len(q)))), max(beam, count + 1)
                while waiting:
                    short = []
                    for k, nodes in zip(waiting, search(graph, q[waiting], width, width), strict=True):
                        nodes = nodes[nodes >= 0]
                        best = _best(x, ids, q[k], nodes, count + 1)
                        if len(best) <= count and len(nodes) == width:
                            short.append(k)  # ids of many vectors fill the beam
                            continue
                        near = sorted((-s, i) for i, s in best.items())
                        out += [(names[k], i, -s) for s, i in near[: count + 1]]
                    waiting, width = short, 2 * width
        columns = list(zip(*out, strict=True)) or [[], [], []]
        kinds = {"query": pa.binary(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({k: pa.array(c, t) for (k, t), c in zip(kinds.items(), columns, strict=True)})

    keys = ["shard", "dim", "block"]
    found = sent.groupBy(*keys).cogroup(index.withColumn("block", every(blocks)).groupBy(*keys)).applyInArrow(answer, "query binary, vec_id bigint, score double")
    order = [F.col("score").desc(), F.col("vec_id")]
    # one more than asked for, as the query's own id may be among them; each id counts once
    best = found.repartition("query").groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    best = work.keep(best.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("n") <= count + 1).drop("n"))
    asked = asked.select(F.col("vec_id").alias("query_id"), "query").distinct()
    own = asked.join(best, "query").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(*order))
    return own.withColumn("rank", rank.cast("int")).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
