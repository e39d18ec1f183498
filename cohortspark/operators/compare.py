"""Comparison of groups: profiles, analysis of variance, chi-square, and the report table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.functions.draws import dealt
from cohortspark.functions.scalars import number_text
from cohortspark.functions.tails import f_tail
from cohortspark.operators.ranks import exact_quantiles, null_safe_join
from cohortspark.operators.reshape import gather, spread
from cohortspark.sources.tables import stack

QUARTILES = {"val_med": 0.5, "val_q1": 0.25, "val_q3": 0.75}


def group_sizes(df: DataFrame, id: str, grp: str) -> DataFrame:
    """Distinct ids per group, NULL counted as one."""
    return df.groupBy(F.col(grp).alias("grp")).agg(
        (F.count_distinct(id) + F.max(F.col(id).isNull().cast("int"))).alias("n")
    )


def _long(df: DataFrame, grp: str, variables: Sequence[str], as_type: str) -> DataFrame:
    return gather(df.withColumn("grp", F.col(grp)), ["grp"], variables, as_type)


# ------------------------------------------------------------------ numbers


def group_moments(long: DataFrame) -> DataFrame:
    """Count, mean and variance of ``val`` per ``var`` and ``grp``."""
    return long.groupBy("var", "grp").agg(
        F.count_if(F.col("val").isNull()).alias("val_miss"),
        F.count("val").alias("val_n"),
        F.avg("val").alias("val_mean"),
        F.stddev_samp("val").alias("val_sd"),
        F.min("val").alias("val_min"),
        F.max("val").alias("val_max"),
    )


def anova(moments: DataFrame) -> DataFrame:
    """One-way analysis of variance per variable from the group moments.

    Rows without a group or a value have no part in it. The window runs over one
    row per group.
    """
    usable = moments.where("grp IS NOT NULL AND val_n > 0")
    per_var = W.partitionBy("var")
    grand = F.sum(F.col("val_n") * F.col("val_mean")).over(per_var) / F.sum("val_n").over(per_var)
    sums = (
        usable.withColumn("_grand", grand)
        .groupBy("var")
        .agg(
            (F.count(F.lit(1)) - 1).alias("df1"),
            (F.sum("val_n") - F.count(F.lit(1))).alias("df2"),
            F.sum(F.col("val_n") * F.pow(F.col("val_mean") - F.col("_grand"), 2)).alias("ss_between"),
            F.sum(
                (F.col("val_n") - 1) * F.pow(F.coalesce("val_sd", F.lit(0.0)), 2)
            ).alias("ss_within"),
        )
    )
    ratio = F.try_divide(
        F.try_divide(F.col("ss_between"), F.col("df1")), F.try_divide(F.col("ss_within"), F.col("df2"))
    )
    return sums.withColumn("f_value", ratio)


def anova_p(statistics: DataFrame) -> DataFrame:
    """Add ``p_value``, the upper tail of the F distribution; one row per variable."""
    return statistics.withColumn("p_value", f_tail("f_value", "df1", "df2"))


def numeric_profile(
    df: DataFrame, id: str, grp: str, variables: Sequence[str], with_p: bool = False
) -> DataFrame:
    """Distinct ids, missing values and spread of each variable in each group, with a label.

    ``with_p`` adds the p-value of the variable's analysis of variance.
    """
    long = _long(df, grp, variables, "double")
    keys = ["var", "grp"]
    out = null_safe_join(group_moments(long), group_sizes(df, id, grp), ["grp"])
    out = null_safe_join(out, exact_quantiles(long, "val", QUARTILES, keys), keys, "left")

    def text(column: str, digits: int) -> Column:
        return number_text(F.col(column), digits)

    label = F.concat(
        F.col("n").cast("string"), F.lit("; "), text("val_mean", 2), F.lit("("), text("val_sd", 3),
        F.lit("); "), text("val_med", 6), F.lit("("), text("val_q1", 6), F.lit(","),
        text("val_q3", 6), F.lit(")"),
    )
    out = out.withColumn("label", label).select(
        *keys, "n", "val_miss", "val_mean", "val_sd", *QUARTILES, "val_min", "val_max", "label"
    )
    if with_p:
        out = out.join(anova_p(anova(group_moments(long))).select("var", "p_value"), "var", "left")
    return out


# --------------------------------------------------------------- categories


def contingency(long: DataFrame) -> DataFrame:
    """Rows per variable, level and group, those with a missing one left out."""
    return (
        long.where("val IS NOT NULL AND grp IS NOT NULL")
        .groupBy("var", "val", "grp")
        .agg(F.count(F.lit(1)).alias("o"))
    )


def chi_square(cells: DataFrame) -> DataFrame:
    """Pearson statistic and degrees of freedom per variable.

    With O observed and R, C, N the margins it is N * (sum of O^2 / (R * C) - 1),
    so that empty cells need not be made.
    """
    rows = cells.groupBy("var", "val").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("var", "grp").agg(F.sum("o").alias("c"))
    share = F.pow(F.col("o").cast("double"), 2) / (F.col("r").cast("double") * F.col("c"))
    return (
        cells.join(rows, ["var", "val"])
        .join(cols, ["var", "grp"])
        .groupBy("var")
        .agg(
            (F.sum("o") * (F.sum(share) - 1)).alias("chisq"),
            ((F.count_distinct("val") - 1) * (F.count_distinct("grp") - 1)).alias("df"),
            F.sum("o").alias("total"),
        )
    )


# a statistic this close to the observed one counts as reaching it
_ALMOST = 1 - 64 * np.finfo(float).eps

# levels that a task draws at a time
_BLOCK_LEVELS = 1000


def _block_totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each draw, how many of each group fall into each block of levels."""
    for batch in batches:
        for job in batch.itertuples():
            rng = np.random.default_rng([job.seed, job.chunk, 0])
            blocks, sizes = zip(*((b["block"], b["r"]) for b in job.blocks), strict=True)
            left = np.tile(np.array(sizes, np.int64), (job.draws, 1))
            parts = []
            for size in job.cols:
                parts.append(dealt(rng, left, np.full(job.draws, size)))
                left = left - parts[-1]
            totals = np.stack(parts, axis=2)
            yield pd.DataFrame(
                {
                    "var": job.var, "block": blocks, "chunk": job.chunk, "seed": job.seed,
                    "totals": [totals[:, i].ravel() for i in range(len(blocks))],
                }
            )


def _block_statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each draw's sum of squared cells over both margins, within a block of levels."""
    for batch in batches:
        for job in batch.itertuples():
            rng = np.random.default_rng([job.seed, job.chunk, 1 + job.block])
            rows, cols = np.asarray(job.rows, np.int64), np.asarray(job.cols, np.int64)
            totals = np.asarray(job.totals, np.int64).reshape(-1, len(cols))
            left = np.tile(rows, (len(totals), 1))
            share = np.zeros(len(totals))
            for size, own in zip(cols, totals.T, strict=True):
                drawn = dealt(rng, left, own)
                left = left - drawn
                share += (drawn.astype(float) ** 2 / rows).sum(1) / float(size)
            yield pd.DataFrame({"var": job.var, "chunk": job.chunk, "draw": np.arange(len(share)), "share": share})


def chi_square_p(cells: DataFrame, replicates: int = 2000, seed: int = 1, chunk: int = 100) -> DataFrame:
    """Monte-Carlo p per variable: share of random tables with the same margins.

    Draws are split into chunks over the cluster, each with its own seed. Levels are split into
    blocks: a draw first deals the groups among blocks and then, block by block, among levels, so
    no task holds all levels of a variable. A variable with one level or one group gets no p.
    """
    rows = cells.groupBy("var", "val").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("var", "grp").agg(F.sum("o").alias("c"))
    blocks = rows.groupBy("var").agg(F.ceil(F.count(F.lit(1)) / _BLOCK_LEVELS).alias("_blocks"))
    rows = rows.join(blocks, "var").withColumn("block", F.pmod(F.xxhash64("val"), F.col("_blocks")))
    levels = rows.groupBy("var", "block").agg(_sorted_margin("val", "r").alias("rows"), F.sum("r").alias("r"))
    totals = levels.groupBy("var").agg(F.array_sort(F.collect_list(F.struct("block", "r"))).alias("blocks"))
    tested = chi_square(cells).where("df > 0")
    margins = cols.groupBy("var").agg(_sorted_margin("grp", "c").alias("cols"))
    chunks = -(-replicates // chunk)
    jobs = (
        tested.join(totals, "var")
        .join(margins, "var")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        .withColumn("draws", F.least(F.lit(chunk), F.lit(replicates) - F.col("chunk") * chunk))
        .withColumn("seed", F.lit(seed))
        .select("var", "blocks", "cols", "chunk", "draws", "seed")
        .repartition(chunks, "var", "chunk")
    )
    dealt_out = jobs.mapInPandas(_block_totals, "var string, block long, chunk int, seed int, totals array<long>")
    within = dealt_out.join(levels.drop("r"), ["var", "block"]).join(margins, "var")
    shares = within.mapInPandas(_block_statistics, "var string, chunk int, draw int, share double")
    statistic = F.col("total") * (F.col("share") - 1)
    return (
        shares.groupBy("var", "chunk", "draw")
        .agg(F.sum("share").alias("share"))
        .join(tested, "var")
        .groupBy("var")
        .agg(((F.count_if(statistic >= _ALMOST * F.col("chisq")) + 1) / (F.count(F.lit(1)) + 1)).alias("p_value"))
    )


def _sorted_margin(level: str, size: str) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct(level, size)))
    return F.transform(pairs, lambda pair: pair[size])


def categorical_profile(
    df: DataFrame,
    id: str,
    grp: str,
    variables: Sequence[str],
    miss_scope: str = "variable",
    with_p: bool = False,
    **draws,
) -> DataFrame:
    """Distinct ids per level and group, their share of the group, and missing values.

    Missing values are counted per variable, or per variable and group with
    ``miss_scope='group'``. ``with_p`` adds the simulated p-value of the variable, for which ``draws``
    are options of :func:`chi_square_p`.
    """
    long = gather(df.withColumn("grp", F.col(grp)).withColumn("_id", F.col(id)), ["_id", "grp"], variables, "string")
    totals = group_sizes(df, id, grp).withColumnRenamed("n", "tot")
    scope = ["var"] if miss_scope == "variable" else ["var", "grp"]
    missing = long.groupBy(*scope).agg(F.count_if(F.col("val").isNull()).alias("val_miss"))
    counts = (
        long.where("val IS NOT NULL").groupBy("var", "grp", "val").agg(F.count_distinct("_id").alias("n"))
    )
    out = null_safe_join(null_safe_join(counts, totals, ["grp"]), missing, scope)
    prop = F.bround(F.col("n") / F.col("tot"), 4)
    label = F.concat(
        F.col("n").cast("string"), F.lit("; ("), number_text(prop * 100, 2), F.lit("%)")
    )
    out = out.select(
        "var", "grp", "val", "tot", "val_miss", "n", prop.alias("prop"), label.alias("label")
    )
    if with_p:
        p = chi_square_p(contingency(_long(df, grp, variables, "string")), **draws)
        out = out.join(p, "var", "left")
    return out


# ------------------------------------------------------------------- report


def comparison_table(
    df: DataFrame,
    id: str,
    grp: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    groups: Sequence[str],
    with_p: bool = True,
    miss_scope: str = "variable",
    replicates: int = 2000,
    seed: int = 1,
) -> DataFrame:
    """The report table: ``var``, ``cat``, one column per group, and ``p.value``.

    The first row holds the group sizes, the next ones mean(sd) [miss] of the
    numbers, the rest n(%) [miss] of each level. ``groups`` are the columns; rows
    of other groups are left out.
    """
    def cell(*parts) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    sizes = group_sizes(df, id, grp)
    numbers = null_safe_join(
        group_moments(_long(df, grp, numeric, "double")), sizes, ["grp"]
    )
    mean = cell(
        number_text(F.col("val_mean"), 1), " (", number_text(F.col("val_sd"), 1), ") [",
        number_text(F.col("val_miss") / F.col("n"), 2), "]",
    )
    levels = categorical_profile(df, id, grp, categorical, miss_scope)
    share = cell(
        F.col("n").cast("string"), " (", number_text(F.col("prop") * 100, 1), "%) [",
        number_text(F.col("val_miss") / F.col("tot"), 2), "]",
    )
    rows = stack(
        [
            sizes.select(
                F.lit(0).alias("part"), F.lit("n").alias("var"), F.lit("").alias("cat"), "grp",
                F.col("n").cast("string").alias("cell"),
            ),
            numbers.select(
                F.lit(1).alias("part"), "var", F.lit("mean(sd) [miss]").alias("cat"), "grp",
                mean.alias("cell"),
            ),
            levels.select(
                F.lit(2).alias("part"), "var", cell(F.col("val"), ",n(%) [miss]").alias("cat"), "grp",
                share.alias("cell"),
            ),
        ]
    )
    table = spread(rows, ["part", "var", "cat"], "grp", "cell", groups)
    if with_p:
        moments = group_moments(_long(df, grp, numeric, "double"))
        cells = contingency(_long(df, grp, categorical, "string"))
        p = anova_p(anova(moments)).select("var", "p_value").unionByName(
            chi_square_p(cells, replicates, seed)
        )
        table = table.join(p.select("var", F.bround("p_value", 4).alias("p.value")), "var", "left")
    names = [f"`{g}`" for g in groups] + (["`p.value`"] if with_p else [])
    return table.orderBy("part", "var", "cat").select("var", "cat", *names)
