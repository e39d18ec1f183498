"""Ranks, running totals and exact quantiles that never sort a whole group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.session import checkpointed


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first one in ``order``.

    Spark prunes each input partition to one row per key before the shuffle, so
    a hot key costs no more than any other. ``order`` must be total, else which
    of two equal rows wins is left to chance.
    """
    ranked = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys come from the left side."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
    condition = [F.col(key).eqNullSafe(F.col(f"_r_{key}")) for key in keys]
    return left.join(renamed, condition, how).drop(*(f"_r_{key}" for key in keys))


def _in_ranges(df: DataFrame, by: Sequence[str], *order: str) -> DataFrame:
    """``df`` sorted in ranges of ``by`` and ``order``, with the range's number as ``_bucket``.

    The ranges are cut from a sample of the rows themselves, so any distribution is spread evenly
    over tasks, and a group may span ranges. They are written to the checkpoint folder: a task that
    runs again finds its rows in the same range.
    """
    keys = [*by, *order]
    parts = checkpointed(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    return parts.withColumn("_bucket", F.spark_partition_id())


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = True,
) -> DataFrame:
    """Add ``<c>_cum`` and ``<c>_total`` for each column of ``sums``.

    ``df`` holds one row per ``by`` and ``order`` value. Rows are dealt into ranges; the totals
    of a group's ranges, one row each, give every range its starting offset, and only the rows of
    one range are then summed in order.
    """
    keys = [*by, "_bucket"]
    marked = _in_ranges(df, by, order)
    bucket_order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    before = W.partitionBy(*by).orderBy(bucket_order).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*keys)
        .agg(*(F.sum(c).alias(f"_sum_{c}") for c in sums))
        .select(
            *keys,
            *(F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums),
            *(F.sum(f"_sum_{c}").over(W.partitionBy(*by)).alias(f"{c}_total") for c in sums),
        )
    )
    inside = (
        W.partitionBy(*keys)
        .orderBy(F.col(order).desc() if descending else F.col(order).asc())
        .rowsBetween(W.unboundedPreceding, 0)
    )
    joined = null_safe_join(marked, offsets, keys)
    for c in sums:
        joined = joined.withColumn(f"{c}_cum", F.sum(c).over(inside) + F.col(f"_off_{c}"))
    return joined.drop("_bucket", *(f"_off_{c}" for c in sums))


def running_extremes(
    df: DataFrame,
    order: Sequence[str],
    highest: Mapping[str, str],
    lowest: Mapping[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add, by name, the greatest or least value of a column up to each row in ``order``, equals included.

    A sweep: rows are dealt into ranges of ``by`` and ``order``, the extremes of a group's ranges, one
    row each, are carried over the ranges behind them, and only the rows of one range are gone through
    in order. So a group may be of any size. Missing values are passed over.
    """
    keys = [*by, "_bucket"]
    marked = _in_ranges(df, by, *order)
    turned = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    bucket = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    before = W.partitionBy(*by).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(*keys).orderBy(*turned).rangeBetween(W.unboundedPreceding, W.currentRow)
    kinds = [(name, c, F.max, F.greatest) for name, c in highest.items()]
    kinds += [(name, c, F.min, F.least) for name, c in lowest.items()]
    carried = marked.groupBy(*keys).agg(*(pick(c).alias(f"_in_{name}") for name, c, pick, _ in kinds))
    carried = carried.select(*keys, *(pick(f"_in_{name}").over(before).alias(f"_off_{name}") for name, _, pick, _ in kinds))
    out = null_safe_join(marked, carried, keys)
    return out.select(
        *df.columns, *(both(pick(c).over(inside), F.col(f"_off_{name}")).alias(name) for name, c, pick, both in kinds)
    )


def ordered_bits(value: Column) -> Column:
    """A whole number for each double, in the same order: its sign, exponent and mantissa.

    Adding and dividing by powers of two is exact, so equal values alone get equal numbers (both zeros
    get 0). Infinities come after all other numbers, not-a-number after them.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("int")

    def power(exponent: Column) -> Column:
        return F.pow(F.lit(2.0), exponent)

    # the logarithm is rounded, so the exponent may be one off
    exponent = guess + (power(guess + 1) <= size).cast("int") - (power(guess) > size).cast("int")
    least = power(F.lit(-1022))
    whole = ((size / power(exponent) - 1) * float(1 << 52)).cast("long")
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(F.isnan(size), F.lit((2047 << 52) + 1))
        .when(size == float("inf"), F.lit(2047 << 52))
        .when(size < least, (size / power(F.lit(-1074))).cast("long"))
        .otherwise(F.shiftleft((exponent + 1023).cast("long"), 52) + whole)
    )
    return F.when(value < 0, -bits).otherwise(bits)


# the low bits that each pass of a selection leaves open
_OPEN_BITS = (42, 21, 0)


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles of ``value`` per group, one column per name in ``probs``.

    Distributed selection: the wanted ranks are found by counting, in three passes over ``df``. The
    first one counts the values by their upper bits, the second, of those values whose upper bits hold
    a wanted rank, by the next bits, the third by all bits. Each pass is a partial aggregate of two
    million numbers a group and bracket at most, whatever the data; nothing is sorted but these counts,
    nothing is written, and the result is exact. What ``df`` shuffles itself is reused by the passes.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    rows = rows.withColumn("_bits", ordered_bits(F.col("_v")))
    share = F.array(*(F.lit(float(p)) for p in probs.values()))
    # whole positions below and above each wanted one, in the order of probs
    ranks = F.flatten(
        F.transform(
            share, lambda p: F.array(F.floor(p * (F.col("_all") - 1)), F.ceil(p * (F.col("_all") - 1)))
        )
    )
    wanted, keys = None, list(by)
    for bits in _OPEN_BITS:
        level = f"_b{bits}"
        rows = rows.withColumn(level, F.shiftright("_bits", bits))
        inside = W.partitionBy(*keys)
        end = F.sum("_n").over(inside.orderBy(level).rowsBetween(W.unboundedPreceding, 0))
        sums = [F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_v")]
        if wanted is None:
            counts = rows.groupBy(*keys, level).agg(*sums)
            counts = counts.withColumn("_end", end).withColumn("_all", F.sum("_n").over(inside))
        else:
            # two brackets for each quantile, if there are no groups
            held = null_safe_join(rows, wanted if by else F.broadcast(wanted), keys)
            counts = held.groupBy(*keys, level).agg(*sums, F.max("_off").alias("_off"), F.max("_all").alias("_all"))
            counts = counts.withColumn("_end", end + F.col("_off"))
        counts = counts.withColumn("_off", F.col("_end") - F.col("_n"))
        keys = [*keys, level]
        hit = F.transform(ranks, lambda r: (r >= F.col("_off")) & (r < F.col("_end")))
        if bits:
            wanted = counts.where(F.exists(hit, lambda h: h)).select(*keys, "_off", "_all")
    # two values per wanted quantile are all that is left of a group
    picked = (
        counts.select(*by, "_v", "_all", F.posexplode(hit).alias("_i", "_held"))
        .where("_held")
        .groupBy(*by)
        .agg(
            F.max("_all").alias("_all"),
            F.map_from_entries(F.collect_list(F.struct("_i", "_v"))).alias("_at"),
        )
    )

    def between(i: int, p: float) -> Column:
        low, high = F.col("_at")[2 * i], F.col("_at")[2 * i + 1]
        position = F.lit(float(p)) * (F.col("_all") - 1)
        part = position - F.floor(position)
        # equal ends may be infinite
        return F.when((part == 0) | (low == high), low).otherwise(low + (high - low) * part)

    return picked.select(
        *by, *(between(i, p).alias(name) for i, (name, p) in enumerate(probs.items()))
    )


def with_row_index(df: DataFrame, keys: Sequence[str], name: str = "row_index") -> DataFrame:
    """Add the zero-based position of each row in the order of ``keys``.

    ``keys`` together must be unique. Rows are range-partitioned, sorted and
    written to the checkpoint folder, so that a row's partition and place stay
    what they were when a task is run again. The place within the partition plus
    the size of the partitions before it is the position; no second shuffle is
    needed.
    """
    parts = checkpointed(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    # the generated id is the partition number in front of the row's place in it
    placed = parts.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33).alias("_part")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # one row per partition, so the hint has a bound: the partition count
    offsets = F.broadcast(
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )
    place = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, place + F.col("_off"))
        .drop("_part", "_off", "_id")
    )


def row_pages(df: DataFrame, keys: Sequence[str], size: int = 1000) -> DataFrame:
    """Number the rows by ``keys`` and add the zero-based ``page`` of ``size`` rows."""
    indexed = with_row_index(df, keys)
    return indexed.withColumn("page", F.floor(F.col("row_index") / F.lit(size)).cast("long"))


def row_page(df: DataFrame, keys: Sequence[str], page: int, size: int = 1000) -> DataFrame:
    """The rows of one page, half-open, so that no row falls between two pages.

    Only the keys are numbered. The page's first and last key then bound the scan of ``df``, which
    can skip what lies outside.
    """
    indexed = with_row_index(df.select(*keys), keys)
    whole = F.struct(*keys)
    own = indexed.where((F.col("row_index") >= page * size) & (F.col("row_index") < (page + 1) * size))
    edges = own.agg(F.min(whole).alias("low"), F.max(whole).alias("high"))
    low, high = edges.select("low").scalar(), edges.select("high").scalar()
    first = F.col(keys[0])
    near = first.between(edges.select(f"low.{keys[0]}").scalar(), edges.select(f"high.{keys[0]}").scalar())
    return df.where(near | first.isNull()).where((whole >= low) & (whole <= high))


def key_digit_chunk(df: DataFrame, key: str, chunk: int, digits: int = 1) -> DataFrame:
    """Rows whose padded key carries the number ``chunk`` from its third character on.

    ``digits=1`` splits the table into ten full parts; ``digits=3`` is a stable
    sample of about one row in a thousand per chunk.
    """
    from cohortspark.functions.scalars import key_digits

    return df.where(key_digits(F.col(key), digits) == chunk)
