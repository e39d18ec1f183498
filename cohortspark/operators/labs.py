"""White-cell counts: percentages, ratios, flags and first values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import (
    after_last_colon,
    is_unit,
    matches,
    range_flag,
    safe_ratio,
    share_of_total,
)
from cohortspark.operators.ranks import exact_quantiles, first_per, null_safe_join

MOMENT = ["patient_num", "encounter_num", "start_since_lab"]
COLUMNS = [
    "patient_num", "encounter_num", "wbc_type", "component_id", "nval_num", "units",
    "start_date", "start_since_lab",
]
# a base type and the suffix of the ratios to it
RATIO_BASES = {"Lymphocyte": "-to-Lymph", "Neutrophils": "-to-Neut"}
QUANTILES = {
    "val_min": 0.0, "val_5perc": 0.05, "val_25perc": 0.25, "val_50perc": 0.5,
    "val_75perc": 0.75, "val_95perc": 0.95, "val_max": 1.0,
}


def lab_values(
    facts: DataFrame, ranges: DataFrame, concept: str = r"\|COMPONENT_ID", unit: str = "K/UL"
) -> DataFrame:
    """Distinct exact measurements of the listed components in the given unit."""
    return (
        facts.where(
            matches(F.col("concept_cd"), concept)
            & (F.col("tval_char") == "E")
            & is_unit(F.col("units_cd"), unit)
        )
        .withColumn("component_id", after_last_colon(F.col("concept_cd")))
        .withColumn("units", F.upper("units_cd"))
        .join(ranges.select("wbc_type", "component_id"), "component_id")
        .select(*COLUMNS)
        .distinct()
    )


def against_bases(values: DataFrame, bases: Sequence[str], total: str = "WBC") -> DataFrame:
    """Each component beside every base value of the same moment, as ``base`` and ``nval_base``.

    One join serves all bases. The total itself and the base are no components of theirs.
    """
    base = values.where(F.col("wbc_type").isin(*bases)).select(
        *MOMENT, F.col("wbc_type").alias("base"), F.col("nval_num").alias("nval_base")
    )
    parts = values.where(F.col("wbc_type") != total)
    return null_safe_join(parts, base, MOMENT).where(F.col("wbc_type") != F.col("base"))


def _percent(pairs: DataFrame, total: str) -> DataFrame:
    share = share_of_total(F.col("nval_num"), F.col("nval_base"))
    return (
        pairs.where(F.col("base") == total)
        .withColumn("nval_num", share)
        .withColumn("units", F.lit("%"))
    )


def _ratio(pairs: DataFrame, base: str) -> DataFrame:
    return (
        pairs.where(F.col("base") == base)
        .withColumn("nval_num", safe_ratio(F.col("nval_num"), F.col("nval_base")))
        .withColumn("wbc_type", F.concat("wbc_type", F.lit(RATIO_BASES[base])))
        .withColumn("units", F.lit("ratio"))
    )


def lab_percent(values: DataFrame, total: str = "WBC") -> DataFrame:
    """Percent of the total count."""
    return _percent(against_bases(values, [total], total), total).select(*COLUMNS).distinct()


def lab_ratio(values: DataFrame, base: str) -> DataFrame:
    """Ratio of each other component to ``base``."""
    return _ratio(against_bases(values, [base]), base).select(*COLUMNS).distinct()


def lab_engineered(values: DataFrame, ranges: DataFrame, total: str = "WBC") -> DataFrame:
    """Counts and percentages with their range flag, and the ratios without one.

    The counts, their parts and their bases all read one shuffle of the distinct
    values. The role each of them filters by is carried as an aggregate: a filter
    on a grouping column would move below the shuffle and make three of it.
    """
    kinds = [total, *RATIO_BASES]
    role = F.lit(-1)
    for i, name in enumerate(kinds):
        role = F.when(F.col("wbc_type") == name, F.lit(i)).otherwise(role)
    shared = values.groupBy(*COLUMNS).agg(F.max(role).alias("_role"))
    kind, base, value = F.col("wbc_type"), F.col("base"), F.col("nval_num")
    bases = shared.where("_role >= 0").select(
        *MOMENT, kind.alias("base"), F.col("_role").alias("base_role"), value.alias("nval_base")
    )
    suffix = F.lit(None).cast("string")
    for name, text in RATIO_BASES.items():
        suffix = F.when(base == name, F.lit(text)).otherwise(suffix)
    is_total = base == total
    derived = (
        null_safe_join(shared.where("_role <> 0"), bases, MOMENT)
        .where("_role <> base_role")
        .select(
            "patient_num",
            "encounter_num",
            F.when(is_total, kind).otherwise(F.concat(kind, suffix)).alias("wbc_type"),
            "component_id",
            F.when(is_total, share_of_total(value, F.col("nval_base")))
            .otherwise(safe_ratio(value, F.col("nval_base")))
            .alias("nval_num"),
            F.when(is_total, F.lit("%")).otherwise(F.lit("ratio")).alias("units"),
            "start_date",
            "start_since_lab",
        )
        .distinct()
    )
    both = shared.where("_role >= -1").select(*COLUMNS).unionByName(derived)
    limits = ranges.select(
        "component_id", "normal_low", "normal_high", "normal_lowp", "normal_highp"
    )
    percent = F.col("units") == "%"
    low = F.when(percent, F.col("normal_lowp")).otherwise(F.col("normal_low"))
    high = F.when(percent, F.col("normal_highp")).otherwise(F.col("normal_high"))
    flag = F.when(F.col("units") != "ratio", range_flag(value, low, high))
    return both.join(limits, "component_id").select(*COLUMNS, flag.alias("nval_fac"))


def lab_initial(engineered: DataFrame) -> DataFrame:
    """One value per stay, type, component and unit: the one with the greatest relative time."""
    return first_per(
        engineered,
        ["patient_num", "encounter_num", "wbc_type", "component_id", "units"],
        [
            F.col("start_since_lab").desc_nulls_last(),
            F.col("start_date"),
            F.col("nval_num").asc_nulls_last(),
        ],
    )


def lab_quantiles(engineered: DataFrame) -> DataFrame:
    """Spread of the values per type and unit."""
    return exact_quantiles(engineered, "nval_num", QUANTILES, ["wbc_type", "units"])
