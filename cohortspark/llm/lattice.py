"""Near-duplicate vectors by hashing to the lattice E8.

In each of several tables a vector is projected to a few blocks of eight numbers and each block is
decoded to the nearest point of E8; the points together name a cell. A vector is looked for in its
own cell and, for each block, in the cell with that block's second point instead. Pairs that meet
are verified by cosine in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import Scratch, mixed, parallelism
from cohortspark.llm.graph import components, local_roots


#: vectors and keys that a task compares at a time
BIN_BYTES = 8 << 20
#: pairs of a cell, or of two blocks of it, from which on they are compared by one matrix product
MANY = 1 << 14


def _d8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and second points of the lattice D8 (whole numbers with an even sum)."""
    near = np.rint(x)
    gap = x - near
    order = np.argsort(-np.abs(gap), axis=-1)
    step = np.where(gap >= 0, 1.0, -1.0)
    odd = near.sum(-1) % 2 != 0

    def flipped(point: np.ndarray, places: np.ndarray) -> np.ndarray:
        out = point.copy()
        np.put_along_axis(out, places, np.take_along_axis(point + step, places, -1), -1)
        return out

    first = np.where(odd[..., None], flipped(near, order[..., :1]), near)
    second = np.where(odd[..., None], flipped(near, order[..., 1:2]), flipped(near, order[..., :2]))
    return first, second


def e8_points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest point of E8 for rows of eight numbers, and the next candidate, both doubled (integers)."""
    half = 0.5
    a = [*_d8(x)]
    b = [p + half for p in _d8(x - half)]
    points = np.stack([*a, *b])
    away = ((points - x) ** 2).sum(-1)
    order = np.argsort(away, axis=0, kind="stable")
    best = np.take_along_axis(points, order[:1][..., None], 0)[0]
    next_ = np.take_along_axis(points, order[1:2][..., None], 0)[0]
    return np.rint(2 * best).astype(np.int64), np.rint(2 * next_).astype(np.int64)


class Tables:
    """Cell keys of vectors in all tables: own cells and neighbouring ones."""

    def __init__(self, dim: int, tables: int, blocks: int, scale: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.tables, self.blocks = tables, blocks
        self.project = rng.standard_normal((tables, blocks, dim, 8)) * scale / np.sqrt(8)
        self.odd = rng.integers(1, 1 << 62, (blocks, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """keys[vector, table, 0] of the own cell, [.., 1 + block] of the neighbour in that block."""
        out = np.zeros((len(unit), self.tables, 1 + self.blocks), np.uint64)
        for t in range(self.tables):
            best, other = [], []
            for b in range(self.blocks):
                for found, points in zip((best, other), e8_points(unit @ self.project[t, b]), strict=True):
                    found.append(mixed((points.astype(np.uint64) * self.odd[b]).sum(-1, dtype=np.uint64) + np.uint64(b)))
            for j in range(1 + self.blocks):
                parts = [other[b] if j == b + 1 else best[b] for b in range(self.blocks)]
                out[:, t, j] = mixed(np.sum(parts, axis=0, dtype=np.uint64) + np.uint64(t))
        return out


def usable(vector: str) -> F.Column:
    """Whether a vector takes part: not null, not zero, and without null or non-finite components."""
    column = F.col(vector).cast("array<double>")
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~odd & F.exists(column, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.93,
    tables: int = 12, blocks: int = 2, scale: float = 1.2, seed: int = 20, block_rows: int = 512,
) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null and their cosine is at least ``cosine``,
    computed in double precision for all pairs that meet in a cell. Vectors that are null, zero or
    hold null or non-finite components link with nothing, nor do vectors of different lengths.
    Equal vectors of a label are one class, compared once; n_links counts rows. component_id is the
    smallest vec_id in reach (null ids are passed over, so it may be null only for a row that has no
    id and no link), kept marks rows that carry it. Rows of one vec_id each get their own row.

    Cells are first counted by key alone; vectors are sent only to cells in which two meet. A cell
    of more than ``block_rows`` classes is split, and every two of its blocks meet by themselves. Cells
    and pairs of blocks are dealt by hash into bins of about eight megabytes, which grow in number with
    the vectors that meet; a task goes through a bin at once, and gives counts and spanning edges, never
    the pairs. A pair that meets in several cells counts in the first of them, which both vectors' keys
    tell.
    """
    spark = vectors.sparkSession
    work = Scratch(spark, "lattice")
    good = usable(vector) & F.col(label).isNotNull()
    # adding 0.0 makes the two zeros one
    values = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"), F.when(good, F.col(label).cast("string")).alias("label"), F.when(good, values).alias("v")
    )
    ident = F.when(F.col("v").isNotNull(), F.unhex(F.md5(F.to_json(F.struct("label", "v")))))
    rows = work.keep(rows.withColumn("class", ident))
    classes = work.keep(
        rows.where(F.col("v").isNotNull())
        .groupBy("class")
        .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    )

    def hashed(batches):
        made: dict[int, Tables] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                lists = part.column("v")
                sizes = np.diff(lists.offsets.to_numpy())
                label_hash = [hash_bytes(x.encode()) for x in part.column("label").to_pylist()]
                for dim in np.unique(sizes):
                    at = np.flatnonzero(sizes == dim)
                    sub = part.take(pa.array(at))
                    x = sub.column("v").flatten().to_numpy().reshape(len(at), dim)
                    unit = x / np.linalg.norm(x, axis=1)[:, None]
                    if int(dim) not in made:
                        made[int(dim)] = Tables(int(dim), tables, blocks, scale, seed)
                    keys = made[int(dim)].keys(unit) + np.array(label_hash, np.uint64)[at][:, None, None]
                    yield pa.RecordBatch.from_arrays(
                        [
                            sub.column("class"),
                            pa.array([u.tobytes() for u in unit], pa.binary()),
                            pa.array([k.tobytes() for k in keys], pa.binary()),
                            pa.array(list(keys.reshape(len(at), -1).astype(np.int64)), pa.list_(pa.int64())),
                            sub.column("weight"),
                        ],
                        ["class", "unit", "keys", "cells", "weight"],
                    )

    hashes = work.keep(classes.select("class", "label", "v", "weight").mapInArrow(hashed, "class binary, unit binary, keys binary, cells array<bigint>, weight bigint"))
    each = hashes.select("class", F.posexplode("cells").alias("place", "cell"))
    own = (F.col("place") % (1 + blocks) == 0).cast("long")
    met = each.groupBy("cell").agg(F.sum(own).alias("own"), F.count("*").alias("all")).where("own > 0 and all > 1")
    met = met.select("cell", F.ceil(F.col("all") / block_rows).cast("int").alias("parts"))
    each = work.keep(each.join(met, "cell"))
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    role = F.col("place") % (1 + blocks)
    # side 0: own rows of block a (left), 1: all rows of block b (right), 2: both, in cells of one block
    one = each.where("parts = 1").select("cell", "class", "place", F.lit(0).alias("a"), F.lit(0).alias("b"), F.when(role == 0, 2).otherwise(1).alias("side"))
    many = each.where("parts > 1")
    left = many.where(role == 0).select("cell", "class", "place", part.alias("a"), F.explode(others).alias("b"), F.lit(0).alias("side"))
    right = many.select("cell", "class", "place", F.explode(others).alias("a"), part.alias("b"), F.lit(1).alias("side"))
    meet = work.keep(one.union(left).union(right))
    # a row takes its vector and its keys to its bin
    row_bytes = 8 * ((classes.agg(F.max(F.size("v"))).first()[0] or 0) + tables * (1 + blocks)) + 100
    bins = max(parallelism(spark), -(-meet.count() * row_bytes // BIN_BYTES))
    bin_ = F.pmod(F.xxhash64("cell", "a", "b"), F.lit(bins)).alias("bin")
    meetings = meet.select("*", bin_).join(hashes.select("class", "unit", "keys", "weight"), "class")

    def verify(table: pa.Table) -> pa.Table:
        return _meet(table, cosine, tables, blocks)

    found = work.keep(meetings.groupBy("bin").applyInArrow(verify, "class binary, links bigint, root binary"))
    work.drop(meet)
    links = found.where("links > 0").groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.where("root is not null and root <> class").select(F.col("class").alias("a"), F.col("root").alias("b")), work)
    known = classes.select("class", "weight", "least").join(links, "class", "left")
    known = known.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    known = work.keep(known)
    # written: adaptive execution splits a large component's rows only in a join without an aggregate
    least = work.keep(known.groupBy("root").agg(F.min("least").alias("component_id")))
    known = known.join(least, "root").select("class", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "class").join(known, "class", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def hash_bytes(raw: bytes) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")


def _near(x: np.ndarray, group: np.ndarray, side: np.ndarray, cosine: float, most: int = 1 << 15):
    """Pairs (left, right) of rows of one group with at least ``cosine``, some at a time.

    Groups are numbered from 0 and stand one after the other; side 0 is left, 1 right, 2 both.
    """
    lefts, rights = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    count = group[-1] + 1 if len(group) else 0
    of = group[lefts]
    begins = np.searchsorted(group[rights], np.arange(count + 1))
    partners = np.diff(begins)
    large = np.bincount(of, minlength=count) * partners >= MANY
    for g in np.flatnonzero(large).tolist():
        i, j = lefts[of == g], rights[begins[g] : begins[g + 1]]
        p, q = np.nonzero(x[i] @ x[j].T >= cosine)
        yield i[p], j[q]
    lefts, of = lefts[~large[of]], of[~large[of]]
    sizes = partners[of]
    batch = np.cumsum(sizes) // most
    for own in np.split(np.arange(len(lefts)), np.flatnonzero(np.diff(batch)) + 1) if len(lefts) else []:
        size = sizes[own]
        i = np.repeat(lefts[own], size)
        j = rights[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begins[of[own]], size)]
        near = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
        yield i[near], j[near]


def _meet(table: pa.Table, cosine: float, tables: int, blocks: int) -> pa.Table:
    """Counts and spanning edges of the links in the cells of a bin."""
    cells = np.column_stack([table.column(c).to_numpy() for c in ("cell", "a", "b")])
    order = np.lexsort(cells.T[::-1])
    table, cells = table.take(pa.array(order)), cells[order]
    classes, units = table.column("class").to_pylist(), table.column("unit").to_pylist()
    names = {c: i for i, c in enumerate(sorted(set(classes)))}
    node = np.array([names[c] for c in classes], np.int64)
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64).reshape(len(node), tables, 1 + blocks)
    place, side, weight = (table.column(c).to_numpy() for c in ("place", "side", "weight"))
    total, a, b, wide = np.zeros(len(names), np.int64), [], [], 1 + blocks
    sizes = np.array([len(u) for u in units])
    for size in np.unique(sizes).tolist():  # vectors of other lengths share a cell by chance only
        own = np.flatnonzero(sizes == size)
        x = np.frombuffer(b"".join(units[i] for i in own.tolist())).reshape(len(own), -1)
        new = np.ones(len(own), bool)
        new[1:] = (cells[own][1:] != cells[own][:-1]).any(axis=1)
        for i, j in _near(x, np.cumsum(new) - 1, side[own], cosine):
            i, j = own[i], own[j]
            # own cells meet twice: take them in the order of their names
            keep = (node[i] != node[j]) & ((place[j] % wide != 0) | (node[i] < node[j]))
            if not keep.any():
                continue
            p, q = i[keep], j[keep]
            first = _first_meeting(keys, p, q, node, tables, wide)
            swapped = node[p] > node[q]
            here = place[q] // wide * (1 + 2 * blocks) + np.where(place[q] % wide == 0, 0, place[q] % wide + np.where(swapped, blocks, 0))
            once = first == here
            np.add.at(total, node[p[once]], weight[q[once]])
            np.add.at(total, node[q[once]], weight[p[once]])
            a.append(node[p])
            b.append(node[q])
    root = local_roots(len(names), np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b]))
    order = sorted(names)
    linked = np.flatnonzero((total > 0) | (root != np.arange(len(names))))
    return pa.table(
        {
            "class": pa.array([order[i] for i in linked], pa.binary()),
            "links": pa.array(total[linked], pa.int64()),
            "root": pa.array([order[root[i]] for i in linked], pa.binary()),
        }
    )


def _first_meeting(k: np.ndarray, p: np.ndarray, q: np.ndarray, node: np.ndarray, tables: int, wide: int) -> np.ndarray:
    """Number of the first meeting of each pair: by table, own cells first, then either one's neighbours."""
    low, high = np.where(node[p] < node[q], p, q), np.where(node[p] < node[q], q, p)
    a, b = k[low], k[high]
    meets = np.concatenate([a[:, :, :1] == b[:, :, :1], a[:, :, :1] == b[:, :, 1:], a[:, :, 1:] == b[:, :, :1]], axis=2)
    return np.argmax(meets.reshape(len(p), -1), axis=1)
