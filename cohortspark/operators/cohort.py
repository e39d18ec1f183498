"""Who belongs to the cohort: concept matching, status steps, eligible stays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import like_any, not_before
from cohortspark.operators.ranks import null_safe_join


class StatusStep(NamedTuple):
    """One step of the status waterfall: its labels and its concept-path patterns."""

    status: int
    lab: int
    patterns: Sequence[str]


def concepts_matching(
    concepts: DataFrame,
    patterns: Sequence[str],
    code: str = "concept_cd",
    path: str = "concept_path",
) -> DataFrame:
    """Distinct codes whose path matches any LIKE pattern."""
    return concepts.where(like_any(F.col(path), patterns)).select(code).distinct()


def prefix_matches(codes: DataFrame, code: str, keys: DataFrame, key: str = "icd_key") -> DataFrame:
    """Join rows to every key that their code starts with.

    A LIKE join would compare each code to each key. Here codes are cut to the few lengths that keys
    have, and the pieces joined by equality, each row once for each key. Rows are read once, and stay
    where they are if the keys are few enough to be sent to them, which the optimizer knows of literal
    tables and adaptive execution of others.
    """
    lengths = keys.where(F.col(key).isNotNull()).agg(F.collect_set(F.length(key))).scalar()
    cut = codes.withColumn("_length", F.explode(lengths)).where(F.col("_length") <= F.length(code))
    return cut.withColumn(key, F.left(F.col(code), F.col("_length"))).drop("_length").join(keys, key)


def _tagged(
    facts: DataFrame,
    concepts: DataFrame,
    steps: Sequence[StatusStep],
    since: str,
    code: str,
    path: str,
    date: str,
) -> DataFrame:
    """Facts since the floor date with the lowest step their concept belongs to."""
    rank = F.coalesce(
        *(F.when(like_any(F.col(path), s.patterns), F.lit(i)) for i, s in enumerate(steps))
    )
    coded = (
        concepts.select(code, rank.alias("step"))
        .where(F.col("step").isNotNull())
        .groupBy(code)
        .agg(F.min("step").alias("step"))
    )
    return facts.where(not_before(facts, date, since)).join(coded, code)


def _labelled(df: DataFrame, steps: Sequence[StatusStep]) -> DataFrame:
    status = reduce(
        lambda out, i: F.when(F.col("step") == i, F.lit(steps[i].status)).otherwise(out),
        range(len(steps)),
        F.lit(None).cast("int"),
    )
    lab = reduce(
        lambda out, i: F.when(F.col("step") == i, F.lit(steps[i].lab)).otherwise(out),
        range(len(steps)),
        F.lit(None).cast("int"),
    )
    return df.select(
        "patient_num", "encounter_num", status.alias("pos_confirmed"), lab.alias("lab_int")
    )


def status_waterfall(
    facts: DataFrame,
    concepts: DataFrame,
    steps: Sequence[StatusStep],
    since: str,
    dedup: bool = True,
    code: str = "concept_cd",
    path: str = "concept_path",
    date: str = "start_date",
) -> DataFrame:
    """Status rows of the patients: the lowest step a patient reaches, and no later one.

    One pass: facts are tagged with their step, each patient's lowest step is
    found by a partial aggregate, and the rows of that step stay. ``dedup=False``
    keeps one row per fact instead of one per encounter.
    """
    tagged = _tagged(facts, concepts, steps, since, code, path, date).select(
        "patient_num", "encounter_num", "step"
    )
    if dedup:
        tagged = tagged.distinct()
    # counting encounters keeps both sides on the same distinct rows, so that
    # the facts are scanned and shuffled once for the two of them
    lowest = (
        tagged.groupBy("patient_num")
        .agg(F.min("step").alias("step"), F.count("encounter_num").alias("_n"))
        .where("_n >= 0")
        .drop("_n")
    )
    kept = null_safe_join(tagged, lowest, ["patient_num", "step"], "left_semi")
    return _labelled(kept, steps)


def status_waterfall_stepwise(
    facts: DataFrame,
    concepts: DataFrame,
    steps: Sequence[StatusStep],
    since: str,
    dedup: bool = True,
    code: str = "concept_cd",
    path: str = "concept_path",
    date: str = "start_date",
) -> DataFrame:
    """The same waterfall as a chain of anti joins, one step after the other.

    It reads the facts once per step; :func:`status_waterfall` is the one to use
    on large tables. A missing patient id excludes nobody.
    """
    floor = facts.where(not_before(facts, date, since))
    out: DataFrame | None = None
    for step in steps:
        codes = concepts_matching(concepts, step.patterns, code, path)
        rows = floor.join(codes, code).select(
            "patient_num",
            "encounter_num",
            F.lit(step.status).alias("pos_confirmed"),
            F.lit(step.lab).alias("lab_int"),
        )
        if dedup:
            rows = rows.distinct()
        if out is None:
            out = rows
        else:
            out = out.unionByName(rows.join(out.select("patient_num"), "patient_num", "left_anti"))
    return out


def eligible_encounters(
    encounters: DataFrame,
    status: DataFrame,
    diagnoses: DataFrame,
    keys: DataFrame,
    since: str,
    types: Sequence[str],
    dx_type: str = "10",
    dedup: bool = True,
    key: str = "icd_key",
) -> DataFrame:
    """Stays of the given types since the floor date that have a status or a listed diagnosis.

    ``covid_status`` is -1 where only the diagnosis speaks for the stay. A stay
    with several status rows is repeated if ``dedup`` is off.
    """
    floor = F.lit(since).cast("date")
    stay = ["patid", "encounterid"]
    listed = (
        prefix_matches(
            diagnoses.where((F.col("dx_type") == dx_type) & (F.col("admit_date") >= floor)).select(
                *stay, "dx"
            ),
            "dx",
            keys.select(key).distinct(),
            key,
        )
        .select(*stay)
        .distinct()
        .withColumn("listed", F.lit(True))
    )
    known = status.select(
        F.col("patient_num").alias("patid"),
        F.col("encounter_num").alias("encounterid"),
        F.col("pos_confirmed").alias("covid_status"),
    )
    if dedup:
        known = known.distinct()
    return (
        encounters.where((F.col("admit_date") >= floor) & F.col("enc_type").isin(*types))
        .join(known, stay, "left")
        .join(listed, stay, "left")
        .where(F.col("covid_status").isNotNull() | F.col("listed"))
        .drop("listed")
        .withColumn("covid_status", F.coalesce("covid_status", F.lit(-1)))
    )


def in_cohort(df: DataFrame, cohort: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys occur in the cohort."""
    members = cohort.select(*keys).distinct()
    return df.join(members, list(keys), "left_semi")


def case_control_stack(cases: DataFrame, controls: DataFrame) -> DataFrame:
    """Both groups in one table; controls get a sentinel infection time and no age at infection."""
    filled = controls.withColumn(
        "infection_start_dttm", F.lit("1900-01-01").cast("timestamp_ntz")
    ).withColumn("age_at_inf", F.lit(None).cast("int"))
    return cases.unionByName(filled, allowMissingColumns=True)
