"""Shards of near equal bytes by sampled splitters over a key."""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import Scratch, hash_order

#: rows that a range may hold on average before more ranges are made
RANGE_ROWS = 1_000_000


def range_shards(
    docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text", samples: int = 20_000, ranges: int = 32, rounds: int = 3
) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards of near equal bytes.

    The key of a row is (hash of its text, doc_id, a number of its own), so equal texts are neighbours
    and share a shard unless a border falls between them, and rows alike in all columns can be cut too. About ``samples`` keys are drawn with chances in proportion
    to size; their quantiles cut the keys into ``ranges`` ranges a shard (more where a range would hold
    over a million rows). Ranges with over twice the mean size get splitters of their own from a new
    sample, so a text with a third of all rows is cut by doc_id. Sizes of ranges are then counted
    exactly, and a row's shard follows from the bytes before it. Driver and tasks hold the sampled
    keys and one range.

    Size: UTF-8 bytes of the text (null: none) plus 8. Returns doc_id, size, text_crc32 (null for a
    null text), shard (0 ...) and slot (place in the shard, gapless from 0), one row for each row;
    other columns of ``docs`` do not matter. Rows alike in doc_id and text take neighbouring slots.
    A null doc_id sorts first. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = Scratch(spark, "shards")
    rows = work.keep(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + 8).alias("size"),
            F.crc32(F.col(text)).alias("text_crc32"),
            F.coalesce(F.xxhash64(text), F.lit(0)).alias("key"),
            F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("tie"),
            F.monotonically_increasing_id().alias("salt"),
        )
    )
    keys = ["key", "tie", "salt"]
    total, n = rows.agg(F.sum("size"), F.count("*")).first()
    if not n:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    count = max(ranges * shards, math.ceil(n / RANGE_ROWS))

    def sample(frame: DataFrame, size: int) -> list[tuple[int, ...]]:
        """Keys drawn with the chance ``samples * own size / size``: about ``samples`` of them, all if there are fewer."""
        drawn = hash_order(*keys, F.lit(f"sample {size}")) < F.col("size") * samples / size
        return sorted(tuple(r) for r in frame.where(drawn).select(*keys).collect())

    def cut(drawn: list[tuple[int, ...]], parts: int) -> set[tuple[int, ...]]:
        return {drawn[len(drawn) * i // parts] for i in range(1, parts)} if drawn else set()

    borders = sorted(cut(sample(rows, total), count))
    for _ in range(rounds):
        placed = rows.withColumn("range", _range_of(borders)(*keys))
        sizes = placed.groupBy("range").agg(F.sum("size"), F.count("*"), F.count("*") > 1)
        sizes = {r[0]: tuple(r[1:]) for r in sizes.collect()}
        full = [k for k, (size, _, splits) in sizes.items() if splits and size > 2 * total / count]
        if not full:
            break
        inside = sorted(full)
        more = sample(placed.where(F.col("range").isin(inside)), sum(sizes[k][0] for k in inside))
        wanted = {k: math.ceil(sizes[k][0] * count / total) for k in inside}
        found = {k: [] for k in inside}
        for key in more:
            found.setdefault(bisect_right(borders, key), []).append(key)
        grown = sorted(set(borders).union(*(cut(found[k], wanted[k]) for k in inside)))
        if grown == borders:
            break
        borders = grown
    placed = rows.withColumn("range", _range_of(borders)(*keys))
    sizes = sorted(tuple(r) for r in placed.groupBy("range").agg(F.sum("size"), F.count("*")).collect())
    before, place = 0, 0
    starts = []
    for k, size, count_k in sizes:
        starts.append((k, before, place))
        before, place = before + size, place + count_k
    starts = spark.createDataFrame(starts, "range int, bytes_before long, rows_before long")
    inside = Window.partitionBy("range").orderBy(*keys)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("bytes_before") + F.sum("size").over(upto) - F.col("size") / 2
    numbered = work.keep(
        placed.join(F.broadcast(starts), "range").select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.floor(middle * shards / total), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.row_number().over(inside) - 1).alias("place"),
        )
    )
    first = {r[0]: r[1] for r in numbered.groupBy("shard").agg(F.min("place")).collect()}
    first = F.create_map(*(F.lit(x) for pair in first.items() for x in pair))
    work.drop(rows)
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("place") - first[F.col("shard")]).alias("slot"))


def places(borders: np.ndarray, values: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted rows of ``borders`` are at or below each row of ``values``, column by column.

    Rows that tie with borders in a column are told apart by the next one, all rows of a tie at once.
    """
    out = np.zeros(len(values[0]), np.int64)

    def narrow(column: int, begin: int, end: int, rows: np.ndarray) -> None:
        own, value = borders[begin:end, column], values[column][rows]
        low, high = begin + np.searchsorted(own, value, "left"), begin + np.searchsorted(own, value, "right")
        last = column + 1 == borders.shape[1]
        out[rows] = high if last else low
        if not last:
            tied = np.flatnonzero(low != high)
            tied = tied[np.argsort(low[tied], kind="stable")]
            for part in np.split(tied, np.flatnonzero(np.diff(low[tied])) + 1) if len(tied) else []:
                narrow(column + 1, int(low[part[0]]), int(high[part[0]]), rows[part])

    if len(borders):
        narrow(0, 0, len(borders), np.arange(len(out)))
    return out


def _range_of(borders: list[tuple[int, ...]]):
    """Number of borders at or below a key."""
    table = np.array(borders, np.int64).reshape(-1, 3)

    @F.pandas_udf("int")
    def of(key: pd.Series, tie: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series(places(table, [c.to_numpy(np.int64) for c in (key, tie, salt)]).astype(np.int32))

    return of


def write_shards(rows: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """Rows that carry their shard, as Parquet in one folder for each shard, in the order of slots."""
    rows.repartition(F.col(shard)).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
