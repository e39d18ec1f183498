"""Stays over time: new admissions, daily census, length of stay, age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.functions.scalars import (
    days_between,
    number_text,
    present,
    visit_class,
)
from cohortspark.operators.ranks import exact_quantiles, first_per
from cohortspark.sources.refdata import calendar


def with_stay_features(stays: DataFrame) -> DataFrame:
    """Add whole days of stay, the intensive-care flag, and the combined visit class."""
    return (
        stays.withColumn("hosp_los", days_between(F.col("hosp_admsn_dttm"), F.col("hosp_disch_dttm")))
        .withColumn("icu_ind", present(F.col("icu_stay_start_dttm")))
        .withColumn("adt_pat_class", visit_class(F.col("ed_episode"), F.col("adt_pat_class")))
    )


def on_calendar(df: DataFrame, day: Column, span: tuple[str, str], scale: str) -> DataFrame:
    """Add ``date_to_match`` and its rank ``date_rk``; rows outside the span go.

    The calendar has one row per day of ``span``, so it is small by construction.
    """
    days = (
        calendar(df.sparkSession, *span)
        .where(F.col("date_scale") == scale)
        .select(F.col("date").alias("date_to_match"), "date_rk")
    )
    return df.withColumn("date_to_match", day.cast("date")).join(days, "date_to_match")


def _counted(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy("date_rk", *by).agg(
        F.count_distinct("encounter_num").alias("confirmed"),
        F.min("date_to_match").alias("date_to_match"),
    )


def incidence(
    stays: DataFrame,
    span: tuple[str, str],
    scale: str = "date_week",
    start: str = "hosp_admsn_dttm",
    by: tuple[str, ...] = ("adt_pat_class",),
) -> DataFrame:
    """New stays per bucket of time and class, dated by the first day they fall on."""
    columns = list(dict.fromkeys(["encounter_num", start, *by]))
    return _counted(on_calendar(stays.select(*columns), F.col(start), span, scale), list(by))


def icu_incidence(stays: DataFrame, span: tuple[str, str], scale: str = "date_week") -> DataFrame:
    """New intensive-care stays per bucket of time."""
    return incidence(
        stays.where(F.col("icu_stay_start_dttm").isNotNull()), span, scale, "icu_stay_start_dttm", ()
    )


def stay_days(
    stays: DataFrame, start: str, length: str, span: tuple[str, str], *keep: str
) -> DataFrame:
    """One row per day of each stay within ``span``, as ``date_to_match``.

    A stay of n days, cut to whole days and at least one, counts on the n days
    that follow its first. Days outside the span are never made.
    """
    first, last = (F.lit(str(d)).cast("date") for d in span)
    begin = F.col(start).cast("date")
    days = F.greatest(F.col(length).cast("int"), F.lit(1))
    low = F.greatest(F.date_diff(first, begin), F.lit(1))
    high = F.least(F.date_diff(last, begin), days)
    return (
        stays.where(F.col(length).isNotNull() & F.col(start).isNotNull())
        .select(*keep, begin.alias("_begin"), low.alias("_low"), high.alias("_high"))
        .where(F.col("_low") <= F.col("_high"))
        .select(*keep, "_begin", F.explode(F.sequence("_low", "_high")).alias("day"))
        .withColumn("date_to_match", F.date_add("_begin", F.col("day")))
        .drop("_begin")
    )


def census(
    stays: DataFrame,
    span: tuple[str, str],
    scale: str = "date_daily",
    start: str = "hosp_admsn_dttm",
    length: str = "hosp_los",
) -> DataFrame:
    """Stays present per bucket of time and class, among tested patients not found negative."""
    days = stay_days(
        stays.where(F.col("pos_confirmed") > 0), start, length, span, "encounter_num", "adt_pat_class"
    )
    return _counted(on_calendar(days, F.col("date_to_match"), span, scale), ["adt_pat_class"])


def icu_census(stays: DataFrame, span: tuple[str, str], scale: str = "date_daily") -> DataFrame:
    """Intensive-care stays present per bucket of time and class."""
    return census(stays, span, scale, "icu_stay_start_dttm", "icu_length_of_stay_days")


def longest_stays(stays: DataFrame, status: int = 2) -> DataFrame:
    """Longest record per stay of patients with ``status``, emergencies without a stay left out."""
    kept = stays.where(
        (F.col("adt_pat_class") != "Emergency")
        & (F.col("pos_confirmed") == status)
        & F.col("hosp_los").isNotNull()
    ).withColumn("hosp_los", F.greatest("hosp_los", F.lit(1.0)))
    return first_per(
        kept.select("patient_num", "encounter_num", "hosp_los", "hosp_admsn_dttm"),
        ["patient_num", "encounter_num"],
        [F.col("hosp_los").desc(), F.col("hosp_admsn_dttm")],
    )


def los_summary(stays: DataFrame, status: int = 2) -> DataFrame:
    """One row: first and last admission, and the spread of the length of stay."""
    longest = longest_stays(stays, status)
    quartiles = {"los_q1": 0.25, "los_median": 0.5, "los_q3": 0.75}
    points = exact_quantiles(longest, "hosp_los", quartiles).select(F.struct(*quartiles)).scalar()
    moments = longest.agg(
        F.min("hosp_admsn_dttm").alias("first_admission"),
        F.max("hosp_admsn_dttm").alias("last_admission"),
        F.min("hosp_los").alias("los_min"),
        F.avg("hosp_los").alias("los_mean"),
        F.max("hosp_los").alias("los_max"),
        F.stddev_samp("hosp_los").alias("los_sd"),
    )
    return moments.withColumn("_points", points).select(*moments.columns, "_points.*")


def los_buckets(stays: DataFrame, status: int = 2) -> DataFrame:
    """Patients and stays per bucket of length of stay, next to their totals.

    Totals come from the same rollup as the buckets; a patient may be in several.
    """
    los = F.col("hosp_los")
    bucket = (
        F.when(los <= 4, "1-4").when((los > 4) & (los <= 28), "5-28").when(los > 28, "28up")
    )
    counted = (
        longest_stays(stays, status)
        .withColumn("los_grp", bucket)
        .rollup("los_grp")
        .agg(
            F.count_distinct("patient_num").alias("pat_cnt"),
            F.count_distinct("encounter_num").alias("enc_cnt"),
            F.grouping("los_grp").alias("total"),
        )
    )
    # at most five rows are left here
    everything = W.partitionBy()
    return (
        counted.withColumn(
            "pat_n", F.max(F.when(F.col("total") == 1, F.col("pat_cnt"))).over(everything)
        )
        .withColumn("enc_n", F.max(F.when(F.col("total") == 1, F.col("enc_cnt"))).over(everything))
        .where("total = 0")
        .select("los_grp", "pat_n", "enc_n", "pat_cnt", "enc_cnt")
    )


def age_trend(
    stays: DataFrame, span: tuple[str, str], scale: str = "date_biweek"
) -> DataFrame:
    """Age of the admitted over time, by intensive care: median, quartiles, and a label."""
    dated = on_calendar(
        stays.select("patient_num", "hosp_admsn_dttm", "icu_ind", "age_at_admit"),
        F.col("hosp_admsn_dttm"),
        span,
        scale,
    )
    keys = ["date_rk", "icu_ind"]
    counts = dated.groupBy(*keys).agg(
        F.min("date_to_match").alias("date_to_match"),
        F.count_distinct("patient_num").alias("pat_cnt"),
    )
    ages = exact_quantiles(
        dated, "age_at_admit", {"age_median": 0.5, "age_q1": 0.25, "age_q3": 0.75}, keys
    )
    label = F.concat(
        F.col("pat_cnt").cast("string"), F.lit(","), number_text(F.col("age_median"), 2)
    )
    return counts.join(ages, keys, "left").withColumn("label", label)
