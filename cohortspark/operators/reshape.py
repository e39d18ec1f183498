"""Long and wide forms, contingency tables, sparse matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators.ranks import null_safe_join, with_row_index
from cohortspark.session import checkpointed


def gather(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], as_type: str, key: str = "var", value: str = "val"
) -> DataFrame:
    """Columns to rows; the values take one common type."""
    typed = df.select(*ids, *(F.col(c).cast(as_type).alias(c) for c in values))
    return typed.unpivot(list(ids), list(values), key, value)


def spread(
    df: DataFrame, ids: Sequence[str], key: str, value: str, levels: Sequence[str]
) -> DataFrame:
    """Rows to columns for the given levels, in one job; the greatest value wins a shared cell."""
    return df.groupBy(*ids).pivot(key, list(levels)).agg(F.max(value))


def unite(columns: Sequence[str], sep: str = "_") -> Column:
    """Columns as one text, a missing one as ``NA``."""
    return F.concat_ws(sep, *(F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns))


def separate(column: Column, names: tuple[str, str], sep: str = "=") -> list[Column]:
    """Text up to the first separator, and all that follows it, NULL if there is none."""
    parts = F.split(column, F.lit(f"\\Q{sep}\\E"), 2)
    return [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names)]


def repeat_rows(df: DataFrame, times: str, counter: str = "copy") -> DataFrame:
    """Each row as often as ``times`` says, cut to a whole number and at least once."""
    count = F.greatest(F.col(times).cast("int"), F.lit(1))
    return df.withColumn(counter, F.explode(F.sequence(F.lit(1), count)))


#: levels of a block of a grid
_GRID_LEVELS = 1000


def _grid(rows: DataFrame, cols: DataFrame) -> DataFrame:
    """All pairs of the levels in ``row`` and ``col``, made block by block.

    Either side's levels are dealt by hash into blocks of about a thousand, and each level meets every
    block of the other side once; so a task makes the cells of some pairs of blocks and holds the levels
    of none whole.
    """

    def blocks(levels: DataFrame) -> Column:
        return levels.agg(F.greatest(F.ceil(F.count(F.lit(1)) / _GRID_LEVELS), F.lit(1)).cast("long")).scalar()

    down, across = blocks(rows), blocks(cols)

    def dealt(levels: DataFrame, name: str, own: str, own_blocks: Column, other: str, other_blocks: Column) -> DataFrame:
        part = F.pmod(F.xxhash64(name), own_blocks).alias(own)
        return levels.select(name, part, F.explode(F.sequence(F.lit(0).cast("long"), other_blocks - 1)).alias(other))

    left, right = dealt(rows, "row", "_down", down, "_across", across), dealt(cols, "col", "_across", across, "_down", down)
    return left.join(right, ["_down", "_across"]).select("row", "col")


def crosstab(df: DataFrame, row: str, col: str, margin: str = "col") -> DataFrame:
    """Counts and proportions of each pair of levels, empty pairs included.

    ``margin`` names the side whose cells add up to one. Pairs with a missing
    level are not counted. Levels, cells and totals all come from the counts,
    which are few against ``df`` and materialised, so that ``df`` is read once.
    """
    counts = checkpointed(
        df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(F.col(row).alias("row"), F.col(col).alias("col"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = _grid(counts.select("row").distinct(), counts.select("col").distinct())
    totals = counts.groupBy(margin).agg(F.sum("n").alias("_total"))
    return (
        cells.join(counts, ["row", "col"], "left")
        .join(totals, margin)
        .select(
            "row",
            "col",
            F.coalesce("n", F.lit(0)).alias("n"),
            (F.coalesce("n", F.lit(0)) / F.col("_total")).alias("prop"),
        )
    )


def _levels(df: DataFrame, column: str, index: str) -> DataFrame:
    """Sorted distinct values with their position from one."""
    indexed = with_row_index(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], index)
    return indexed.withColumn(index, F.col(index) + 1)


def sparse_coo(
    df: DataFrame,
    row: str,
    col: str,
    value: str | None = None,
    binary: bool = False,
    sum_duplicates: bool = True,
) -> DataFrame:
    """Coordinate rows ``i``, ``j``, ``x`` of the matrix row by col, with both labels.

    Positions count the sorted distinct labels from one. A missing value stands
    for 1 and duplicates add up. ``binary`` sets each present cell to 1, or to its
    number of rows if duplicates are summed.
    """
    if binary or value is None:
        x = F.count(F.lit(1)).cast("double") if sum_duplicates else F.lit(1.0)
    else:
        number = F.coalesce(F.col(value).cast("double"), F.lit(1.0))
        x = F.sum(number) if sum_duplicates else F.max(number)
    present = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    if binary and not sum_duplicates:
        cells = present.select(row, col).distinct().withColumn("x", F.lit(1.0))
    else:
        cells = present.groupBy(row, col).agg(x.alias("x"))
    return (
        cells.join(_levels(df, row, "i"), row)
        .join(_levels(df, col, "j"), col)
        .select("i", "j", "x", row, col)
    )


def sparse_rows(coo: DataFrame) -> DataFrame:
    """One row per ``i``: the sorted positions and the values at them.

    A row holds at most one entry per distinct column label.
    """
    entries = F.array_sort(F.collect_list(F.struct("j", "x")))
    return coo.groupBy("i").agg(entries.alias("entries")).select(
        "i",
        F.transform("entries", lambda e: e["j"]).alias("indices"),
        F.transform("entries", lambda e: e["x"]).alias("values"),
    )


def joined_back(left: DataFrame, statistics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statistics beside the rows they belong to, NULL keys matching each other."""
    return null_safe_join(left, statistics, keys, "left")
