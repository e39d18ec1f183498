"""The three pipelines: cohort extraction, severity models, cohort description."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import decode, keep_listed, matches, present, recode_first
from cohortspark.operators import cohort as co
from cohortspark.operators import extract as ex
from cohortspark.operators import severity as sv
from cohortspark.operators.compare import comparison_table
from cohortspark.operators.evaluate import perf_summary
from cohortspark.operators.ranks import first_per
from cohortspark.operators.regress import Fit, fit_glm, fitted
from cohortspark.session import checkpointed
from cohortspark.sources import refdata
from cohortspark.sources.tables import save_snapshot, save_table, stack


def extract_cohort(
    tables: Mapping[str, DataFrame],
    code_map: DataFrame,
    since: str = "2020-01-01",
    steps: Sequence[co.StatusStep] | None = None,
    prefixes: DataFrame | None = None,
    types: Sequence[str] = refdata.STAY_TYPES,
    status: DataFrame | None = None,
    eligible: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Status, eligible stays, and every extract of the cohort.

    Status and stays are small against the facts and feed all that follows, so
    each is materialised once, unless its stored table is given as ``status`` or
    ``eligible``. The extracts themselves are lazy. ``tables`` holds ``observation_fact``, ``concept_dimension``, ``encounter``,
    ``diagnosis``, ``demographic``, ``death`` and whichever of the event tables
    ``lab``, ``px``, ``vital``, ``pmed``, ``dmed``, ``amed`` there are. ``code_map`` names the site's
    own observation codes.
    """
    spark = tables["observation_fact"].sparkSession
    steps = steps or [co.StatusStep(*s) for s in refdata.STATUS_STEPS]
    prefixes = refdata.respiratory_prefixes(spark) if prefixes is None else prefixes
    facts = tables["observation_fact"]
    if status is None:
        status = checkpointed(
            co.status_waterfall(facts, tables["concept_dimension"], steps, since)
        )
    stays = eligible
    if stays is None:
        stays = checkpointed(
            co.eligible_encounters(
                tables["encounter"], status, tables["diagnosis"], prefixes, since, types
            )
        )
    out = {
        "covid_enc": status,
        "covid_eligible_enc": stays,
        "covid_demo": ex.demographics(stays, tables["demographic"], tables["death"]),
        "covid_dx": ex.diagnosis_history(stays, tables["diagnosis"]),
    }
    for name in ex.EVENT_TABLES:
        if name in tables:
            out[f"covid_{name}"] = ex.extract_events(stays, tables[name], name)
    out["covid_obsclin"] = ex.extract_observations(stays, facts, code_map)
    return out


def store_cohort(
    tables: Mapping[str, DataFrame], code_map: DataFrame, schema: str, **options
) -> dict[str, DataFrame]:
    """Run :func:`extract_cohort` into catalog tables of ``schema``."""
    frames = extract_cohort(tables, code_map, **options)
    return {name: save_table(frame, f"{schema}.{name}") for name, frame in frames.items()}


class SeverityResult(NamedTuple):
    scored: DataFrame
    initial: DataFrame
    horizons: dict[str, DataFrame]


def score_severity(
    facts: DataFrame,
    stays: DataFrame,
    code_map: DataFrame,
    since: str,
    bands: DataFrame | None = None,
    grain: str = "patient",
    hours: int = 12,
) -> SeverityResult:
    """Scored observations, first scores, and worst scores on the three clocks.

    The coded facts of the stays are few against the fact table and are read by
    exposure, pressure and scores, so they are materialised once.
    """
    bands = refdata.severity_bands(facts.sparkSession) if bands is None else bands
    coded = checkpointed(sv.coded_facts(facts, stays, code_map, since))
    scored = sv.scores_from(coded, stays, bands, grain)
    near = sv.scores_from(coded, stays, bands, grain, admission_hours=hours, worst=True)
    worst = sv.scores_from(coded, stays, bands, grain, worst=True)
    horizons = {
        clock: sv.worst_by_horizon(near if clock == "admit" else worst, clock, hours)
        for clock in sv.CLOCKS
    }
    initial = sv.initial_from(coded, stays, bands) if grain == "patient" else sv.initial_score(scored)
    return SeverityResult(scored, initial, horizons)


class ModelResult(NamedTuple):
    fit: Fit
    performance: DataFrame


# name, label, features, restriction of the rows
LOGISTIC_MODELS = [
    ("status_score", "hosdead", ["pos_confirmed", "sofa_init"], None),
    ("score_positive", "hosdead", ["sofa_init"], "pos_confirmed = 2"),
    ("score_negative", "hosdead", ["sofa_init"], "pos_confirmed = 0"),
    ("status_age_score", "hosdead", ["pos_confirmed", "age_at_admit", "sofa_init"], None),
    ("long_exposure", "mv_long", ["pos_confirmed", "sofa_init"], None),
]


def severity_models(
    initial: DataFrame, long_hours: int = 96, drop_negative: bool = False
) -> dict[str, ModelResult]:
    """The five logistic models and the Poisson model of the first scores, each evaluated.

    Every fit reads the scores several times, so they are materialised once. A record may end before
    it starts, and a count model takes no negative hours: they are an error that says how many there
    are, unless ``drop_negative`` leaves them out of the count model.
    """
    rows = initial.withColumn("mv_long", (F.col("mv_dur_hour") >= long_hours).cast("int"))
    rows = checkpointed(rows)
    out = {}
    for name, label, features, only in LOGISTIC_MODELS:
        part = rows.where(only) if only else rows
        fit = fit_glm(part, label, features)
        out[name] = ModelResult(fit, perf_summary(fitted(fit, part, label)))
    counted = counted_hours(rows, drop_negative)
    fit = fit_glm(counted, "mv_dur_hour", ["pos_confirmed", "age_at_admit", "sofa_init"], "poisson")
    reached = fitted(fit, counted, "mv_dur_hour", f"mv_dur_hour >= {long_hours}")
    out["exposure_hours"] = ModelResult(fit, perf_summary(reached))
    return out


def counted_hours(rows: DataFrame, drop_negative: bool = False) -> DataFrame:
    """``rows`` for a model of ``mv_dur_hour`` as a count; negative hours are an error or left out."""
    if drop_negative:
        return rows.where("mv_dur_hour >= 0 OR mv_dur_hour IS NULL")
    negative = rows.where("mv_dur_hour < 0").count()
    if negative:
        raise ValueError(f"{negative} rows have negative hours; drop_negative=True leaves them out")
    return rows


def demographic_stack(cases: DataFrame, controls: DataFrame) -> DataFrame:
    """One row per inpatient stay with its status label and derived groups.

    Of several records of a stay, the one with the longest intensive care stays.
    """
    columns = [
        "patient_num", "encounter_num", "pos_confirmed", "disch_disp", "admsn_dx_group",
        "sex_female", "age_at_admit", "icu_length_of_stay_days",
    ]
    rows = stack([cases, controls] if controls is not None else [cases])
    derived = (
        rows.where(matches(F.col("adt_pat_class"), "Inpatient"))
        .select(*columns)
        .withColumn("pos_confirmed", decode(F.col("pos_confirmed"), refdata.STATUS_LABELS))
        .withColumn("icu_ind", present(F.col("icu_length_of_stay_days")))
        .withColumn("disch_disp_grp", recode_first(F.col("disch_disp"), refdata.DISCHARGE_RULES, "OT"))
        .withColumn(
            "admsn_dx_grp",
            keep_listed(
                F.col("admsn_dx_group"), refdata.ADMISSION_GROUPS, refdata.ADMISSION_PHRASES
            ),
        )
    )
    return first_per(
        derived,
        ["patient_num", "encounter_num"],
        [
            F.col("icu_ind").desc(),
            F.col("icu_length_of_stay_days").desc_nulls_last(),
            F.col("pos_confirmed").asc_nulls_last(),
            F.col("disch_disp").asc_nulls_last(),
            F.col("admsn_dx_group").asc_nulls_last(),
            F.col("age_at_admit").asc_nulls_last(),
            F.col("sex_female").asc_nulls_last(),
        ],
    )


def cohort_report(
    cases: DataFrame, controls: DataFrame, groups: Sequence[str] = ("NEG", "PEND", "POS"), **options
) -> DataFrame:
    """The comparison table of the inpatient stays by status.

    Each part of the table needs other columns of the stays, which would sort
    them out once per part; they are materialised instead.
    """
    return comparison_table(
        checkpointed(demographic_stack(cases, controls)),
        "patient_num",
        "pos_confirmed",
        numeric=["age_at_admit", "icu_length_of_stay_days"],
        categorical=["sex_female", "icu_ind", "disch_disp_grp", "admsn_dx_grp"],
        groups=groups,
        **options,
    )


def save_study(frames: Mapping[str, DataFrame], folder: str) -> None:
    """Snapshot every frame under ``folder`` by its name."""
    for name, frame in frames.items():
        save_snapshot(frame, f"{folder.rstrip('/')}/{name}")
