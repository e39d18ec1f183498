"""Organ-severity scores, ventilation exposure, and scores by hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.functions.scalars import (
    clamped,
    contains_ignoring_case,
    hours_between,
    mean_arterial,
    not_before,
    shifted_hours,
    within_or_open,
)
from cohortspark.operators.ranks import first_per, running_extremes

STAY = ["patient_num", "encounter_num"]
PATIENT_ATTRS = ["pos_confirmed", "hosdead", "age_at_admit", "sex_female"]
CLOCKS = {"admit": "hr_since_admin", "icu": "hr_since_icu", "exposure": "hr_since_mv"}


def coded_facts(
    facts: DataFrame, stays: DataFrame, code_map: DataFrame, since: str
) -> DataFrame:
    """Facts of the stays since the floor date under their code name.

    This is the only step that reads the fact table; exposure, pressure and
    scores all start from it. A fact whose concept has several names is repeated.
    """
    columns = ["instance_num", "start_date", "nval_num", "tval_char"]
    names = code_map.select("code", F.col("i2b2_code").alias("concept_cd"))
    return (
        facts.where(not_before(facts, "start_date", since))
        .join(names, "concept_cd")
        .select(*STAY, "code", *(c for c in columns if c in facts.columns))
        .join(stays.select(*STAY), STAY, "left_semi")
    )


# ------------------------------------------------------------------- bands


def band_holds(value: Column) -> Column:
    """Whether ``value`` lies in the band given by direction, lb, ub and scale_type."""
    direction, lb, ub = F.col("direction"), F.col("lb"), F.col("ub")
    return (
        F.when(direction == "l", value < ub)
        .when(direction == "le", value <= ub)
        .when(direction == "g", value > lb)
        .when(
            direction == "btw",
            (value >= lb)
            & F.when(F.col("scale_type") == "c", value < ub).when(
                F.col("scale_type") == "d", value <= ub
            ),
        )
    )


def band_score(observations: DataFrame, bands: DataFrame, value: str = "nval_num") -> DataFrame:
    """One row per observation and band that holds; ``pat_score`` is the band's score.

    Bands may overlap or leave gaps: a value may score twice or not at all.
    """
    return (
        observations.join(bands, "code")
        .where(band_holds(F.col(value)))
        .withColumnRenamed("score", "pat_score")
    )


def band_lint(bands: DataFrame) -> DataFrame:
    """Gaps, overlaps and bounds that score nothing, per code.

    Every band edge is tried, and the middle between each edge and the next one.
    """
    edges = (
        bands.select("code", F.explode(F.array("lb", "ub")).alias("edge"))
        .where("edge IS NOT NULL")
        .groupBy("code")
        .agg(F.array_sort(F.collect_set("edge")).alias("edges"))
    )
    middles = F.transform(
        F.slice(F.col("edges"), F.lit(1), F.size("edges") - 1),
        lambda edge, i: (edge + F.element_at(F.col("edges"), i + 2)) / 2,
    )
    probes = edges.select("code", F.explode(F.array_union("edges", middles)).alias("value"))
    return (
        probes.join(bands, "code")
        .groupBy("code", "value")
        .agg(F.count_if(band_holds(F.col("value"))).alias("bands"))
        .where("bands <> 1")
        .select("code", "value", F.when(F.col("bands") == 0, "gap").otherwise("overlap").alias("issue"))
    )


def band_coverage(observations: DataFrame, bands: DataFrame, value: str = "nval_num") -> DataFrame:
    """How many observations of each code score nothing, once, or more than once.

    Band rows are folded to one array per code, so each observation is counted in
    place and none is multiplied by its bands.
    """
    fields = ["direction", "lb", "ub", "scale_type"]
    folded = bands.groupBy("code").agg(F.collect_list(F.struct(*fields)).alias("_bands"))

    def holds(band: Column) -> Column:
        v, lb, ub = F.col(value), band["lb"], band["ub"]
        upper = ((band["scale_type"] == "c") & (v < ub)) | ((band["scale_type"] == "d") & (v <= ub))
        return F.coalesce(
            ((band["direction"] == "l") & (v < ub))
            | ((band["direction"] == "le") & (v <= ub))
            | ((band["direction"] == "g") & (v > lb))
            | ((band["direction"] == "btw") & (v >= lb) & upper),
            F.lit(False),
        )

    hits = F.size(F.filter("_bands", holds))
    return (
        observations.join(folded, "code")
        .groupBy("code")
        .agg(
            F.count(F.lit(1)).alias("n_obs"),
            F.count_if(hits == 0).alias("n_unscored"),
            F.count_if(hits == 1).alias("n_once"),
            F.count_if(hits > 1).alias("n_multi"),
        )
    )


# ---------------------------------------------------------------- exposure


def exposure_from(
    coded: DataFrame,
    stays: DataFrame,
    init: str = "Vent_init",
    mode: str = "Vent_mode",
    unassisted: str = "spont",
) -> DataFrame:
    """:func:`exposure_duration` of facts that :func:`coded_facts` has named."""
    moment, code = F.col("start_date"), F.col("code")
    records = (
        coded.where(code.isin(init, mode))
        .where(~((code == mode) & contains_ignoring_case(F.col("tval_char"), unassisted)))
        .select(*STAY, "code", "start_date")
        .join(stays.select(*STAY, "icu_stay_start_dttm", "icu_stay_end_dttm"), STAY)
        .where(within_or_open(moment, F.col("icu_stay_start_dttm"), F.col("icu_stay_end_dttm")))
    )
    times = records.groupBy(*STAY, "icu_stay_end_dttm").agg(
        F.min(F.when(code == init, moment)).alias("init_min"),
        F.min(F.when(code == mode, moment)).alias("mode_min"),
        F.max(F.when(code == mode, moment)).alias("mode_max"),
    )
    start = F.coalesce("init_min", "mode_min")
    end = F.coalesce("mode_max", "icu_stay_end_dttm")
    return (
        times.select(
            "patient_num",
            start.alias("mv_init"),
            hours_between(start, end, 2).alias("mv_dur_hour"),
        )
        .where(F.col("mv_dur_hour").isNotNull())
        .distinct()
    )


def exposure_duration(
    facts: DataFrame,
    stays: DataFrame,
    code_map: DataFrame,
    since: str,
    init: str = "Vent_init",
    mode: str = "Vent_mode",
    unassisted: str = "spont",
) -> DataFrame:
    """Start and hours of ventilation: ``patient_num``, ``mv_init``, ``mv_dur_hour``.

    Starts at the first initiation, or else the first mode record; ends at the
    last mode record, or else with the intensive-care stay. Spontaneous modes do
    not count, nor does what lies outside the intensive-care stay if there is one.
    """
    named = code_map.where(F.col("code").isin(init, mode))
    return exposure_from(coded_facts(facts, stays, named, since), stays, init, mode, unassisted)


def map_from(
    coded: DataFrame,
    systolic: str = "SBP",
    diastolic: str = "DBP",
    recorded: str = "MAP",
    count_duplicates: bool = False,
) -> DataFrame:
    """:func:`derived_map` of facts that :func:`coded_facts` has named."""
    parts = [systolic, diastolic, recorded]
    code, value = F.col("code"), F.col("nval_num")
    greatest = [F.max(F.when(code == p, value)) for p in parts]
    least = [F.min(F.when(code == p, value)) for p in parts]
    several = sum(
        F.coalesce((high > low).cast("int"), F.lit(0)) for high, low in zip(greatest, least)
    )
    wide = (
        coded.where(code.isin(*parts))
        .groupBy(*STAY, "instance_num", "start_date")
        .agg(
            *(high.alias(name) for high, name in zip(greatest, ("sbp", "dbp", "map"))),
            several.alias("dup_cells"),
        )
    )
    out = wide.withColumn(
        "map", mean_arterial(F.col("sbp"), F.col("dbp"), F.col("map"))
    ).where(F.col("map").isNotNull())
    return out if count_duplicates else out.drop("dup_cells")


def derived_map(
    facts: DataFrame,
    stays: DataFrame,
    code_map: DataFrame,
    since: str,
    systolic: str = "SBP",
    diastolic: str = "DBP",
    recorded: str = "MAP",
    count_duplicates: bool = False,
) -> DataFrame:
    """Mean arterial pressure per patient, encounter, instance and time.

    The three components are spread to columns in one aggregate. Where a
    component was recorded with several values, the greatest counts;
    ``count_duplicates`` adds ``dup_cells``, the number of such components.
    """
    named = code_map.where(F.col("code").isin(systolic, diastolic, recorded))
    coded = coded_facts(facts, stays, named, since)
    return map_from(coded, systolic, diastolic, recorded, count_duplicates)


# ------------------------------------------------------------------ scores


def scored_observations(
    facts: DataFrame,
    stays: DataFrame,
    code_map: DataFrame,
    bands: DataFrame,
    since: str,
    grain: str = "patient",
) -> DataFrame:
    """Band-scored observations with hours since admission, intensive care and exposure.

    With ``grain='patient'`` an observation is set against every stay of its
    patient, with ``'encounter'`` against its own one.
    """
    return scores_from(coded_facts(facts, stays, code_map, since), stays, bands, grain)


# an observation's day picks one of so many parts of its patient, whose stays and exposures, few
# against the observations, are in each of them
_PARTS = 32


def banded(
    coded: DataFrame,
    bands: DataFrame,
    pressure: DataFrame | None = None,
    pressure_codes: Sequence[str] = ("SBP", "DBP", "MAP"),
) -> DataFrame:
    """Organ scores of the named facts, the pressures of one moment taken together."""
    pressure = map_from(coded, *pressure_codes) if pressure is None else pressure
    columns = [*STAY, "code", "start_date", "nval_num"]
    direct = coded.where(~F.col("code").isin(*pressure_codes)).select(*columns)
    mean = pressure.select(
        *STAY, F.lit("MAP").alias("code"), "start_date", F.col("map").alias("nval_num")
    )
    return band_score(direct.unionByName(mean), bands).select(*columns, "organ", "pat_score")


def scores_from(
    coded: DataFrame,
    stays: DataFrame,
    bands: DataFrame,
    grain: str = "patient",
    pressure: DataFrame | None = None,
    exposure: DataFrame | None = None,
    pressure_codes: Sequence[str] = ("SBP", "DBP", "MAP"),
    admission_hours: int | None = None,
    worst: bool = False,
) -> DataFrame:
    """:func:`scored_observations` of facts that :func:`coded_facts` has named.

    ``pressure`` and ``exposure`` come from :func:`derived_map` and
    :func:`exposure_duration` and are derived here if not given. With
    ``admission_hours`` nothing later than that after admission is scored; the
    observations then meet a stay by patient and day, so that a patient with
    very many of both does not have every pair of them compared. ``worst`` keeps
    the worst score of an organ at a moment before the join, which is all that
    :func:`worst_by_horizon` needs. Else observations meet stays, and always
    exposures, by patient and a part of the days, so one patient's pairs are
    spread over tasks.
    """
    exposure = exposure_from(coded, stays) if exposure is None else exposure
    scored = banded(coded, bands, pressure, pressure_codes)
    if worst:
        scored = scored.groupBy(*STAY, "organ", "start_date").agg(F.max("pat_score").alias("pat_score"))
    keys = ["patient_num"] if grain == "patient" else STAY
    clocks = stays.select(
        *keys,
        *PATIENT_ATTRS,
        "hosp_admsn_dttm",
        "icu_stay_start_dttm",
        "icu_length_of_stay_days",
    )
    moment, admitted = F.col("start_date"), F.col("hosp_admsn_dttm")
    scored = scored.withColumn("_part", F.pmod(F.unix_date(moment.cast("date")), F.lit(_PARTS)))
    parts = F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1)))
    if admission_hours is not None:
        last = admitted + F.expr(f"INTERVAL '{admission_hours * 60 + 30}' MINUTE")
        days = F.sequence(
            shifted_hours(admitted, -72).cast("date"), last.cast("date"), F.expr("INTERVAL 1 DAY")
        )
        clocks = clocks.where(admitted.isNotNull()).withColumn("_day", F.explode(days))
        scored = scored.withColumn("_day", moment.cast("date"))
        met = scored.join(clocks, [*keys, "_day"]).where(moment <= last).drop("_day")
    else:
        met = scored.join(clocks.withColumn("_part", parts), [*keys, "_part"])
    return (
        met.where(moment >= shifted_hours(admitted, -72))
        .withColumn("hr_since_admin", hours_between(admitted, moment))
        .withColumn("hr_since_icu", _icu_hours())
        .join(exposure.withColumn("_part", parts), ["patient_num", "_part"], "left")
        .drop("_part")
        .where(
            F.col("mv_init").isNull() | (F.col("mv_init") >= shifted_hours(moment, -24))
        )
        .withColumn(
            "hr_since_mv",
            clamped(hours_between(F.col("mv_init"), moment), F.bround("mv_dur_hour")),
        )
    )


def _icu_hours() -> Column:
    return clamped(
        hours_between(F.col("icu_stay_start_dttm"), F.col("start_date")),
        F.bround(F.col("icu_length_of_stay_days") * 24),
    )


def initial_from(
    coded: DataFrame,
    stays: DataFrame,
    bands: DataFrame,
    pressure: DataFrame | None = None,
    exposure: DataFrame | None = None,
    pressure_codes: Sequence[str] = ("SBP", "DBP", "MAP"),
) -> DataFrame:
    """:func:`initial_score` of the patient's observations, without setting them against every stay.

    An observation is scored if it is so against the patient's first stay, and if the patient has no
    exposure or the last one starts late enough: two numbers for each patient. Of each organ the first
    such observation is kept. Only these meet the patient's first stay, and the shortest exposure that
    starts late enough, which a running minimum over exposures and observations in the order of time
    finds.
    """
    exposure = exposure_from(coded, stays) if exposure is None else exposure
    moment = F.col("start_date")
    admitted = stays.groupBy("patient_num").agg(F.min("hosp_admsn_dttm").alias("_admitted"))
    exposed = exposure.groupBy("patient_num").agg(F.max("mv_init").alias("_exposed"))
    scored = (
        banded(coded, bands, pressure, pressure_codes)
        .join(admitted.join(exposed, "patient_num", "left"), "patient_num")
        .where(moment >= shifted_hours(F.col("_admitted"), -72))
        .where(F.col("_exposed").isNull() | (F.col("_exposed") >= shifted_hours(moment, -24)))
    )
    first = first_per(scored, [*STAY, "organ"], [moment, F.col("pat_score").desc()]).select(
        *STAY, "organ", "start_date", "pat_score", "_admitted"
    )
    # an exposure at the same time as the bound of an observation comes before it
    events = first.withColumn("_at", shifted_hours(moment, -24)).unionByName(
        exposure.select("patient_num", F.col("mv_init").alias("_at"), F.col("mv_dur_hour").alias("_hours")),
        allowMissingColumns=True,
    )
    later = W.partitionBy("patient_num").orderBy(F.col("_at").desc(), F.col("_hours").isNull())
    first = events.withColumn("mv_dur_hour", F.min("_hours").over(later.rowsBetween(W.unboundedPreceding, 0)))
    first = first.where("organ IS NOT NULL").drop("_hours", "_at")
    opening = stays.select(
        "patient_num", *PATIENT_ATTRS, "hosp_admsn_dttm", "icu_stay_start_dttm", "icu_length_of_stay_days"
    ).withColumnRenamed("hosp_admsn_dttm", "_admitted")
    met = (
        first.join(opening, ["patient_num", "_admitted"])
        .withColumn("hosp_admsn_dttm", F.col("_admitted"))
        .withColumn("hr_since_admin", hours_between(F.col("_admitted"), moment))
        .withColumn("hr_since_icu", _icu_hours())
        .withColumn("hr_since_mv", F.lit(None).cast("double"))
    )
    return initial_score(met)


def worst_by_horizon(
    scored: DataFrame, clock: str = "admit", horizons: int = 12, cumulative: bool = False
) -> DataFrame:
    """Sum over organs of the worst score per hour, for every hour within each horizon.

    ``clock`` is ``admit``, ``icu`` or ``exposure``. The horizons 1 to
    ``horizons`` are filled by one expand of the hourly sums. With ``cumulative``
    there is one row per stay and horizon instead, and the worst score of an
    organ is taken over all hours up to the horizon.
    """
    hour = CLOCKS[clock]
    owner = [*STAY, *PATIENT_ATTRS]
    near = scored.where(F.col(hour) <= horizons)
    until = F.explode(
        F.sequence(
            F.greatest(F.col(hour), F.lit(1.0)).cast("int"), F.lit(horizons)
        )
    )
    if cumulative:
        worst = near.groupBy(*owner, "organ", hour).agg(F.max("pat_score").alias("pat_score"))
        worst = (
            worst.withColumn(f"{hour}_cum", until)
            .groupBy(*owner, "organ", f"{hour}_cum")
            .agg(F.max("pat_score").alias("pat_score"))
        )
        return worst.groupBy(*owner, f"{hour}_cum").agg(
            F.sum("pat_score").alias("sofa"), F.count(F.lit(1)).alias("organ_scored")
        )
    # the greatest struct is the worst score, ties going to the greatest attributes
    top = F.max(F.struct("pat_score", *PATIENT_ATTRS)).alias("top")
    worst = near.groupBy(*STAY, "organ", *CLOCKS.values()).agg(top)
    hourly = (
        worst.select(*STAY, "organ", hour, "top.*")
        .groupBy(*owner, hour)
        .agg(F.sum("pat_score").alias("sofa"), F.count_distinct("organ").alias("organ_scored"))
    )
    return hourly.withColumn(f"{hour}_cum", until)


def cumulative_by_horizon(
    coded: DataFrame,
    stays: DataFrame,
    bands: DataFrame,
    clock: str = "admit",
    horizons: int = 12,
    pressure: DataFrame | None = None,
    exposure: DataFrame | None = None,
    pressure_codes: Sequence[str] = ("SBP", "DBP", "MAP"),
) -> DataFrame:
    """:func:`worst_by_horizon` with ``cumulative``, of the patient's observations, without any pair.

    Of all stays of a patient with the same attributes, an observation needs only the one that puts it
    earliest on the clock. Which hour that is follows from running extremes over the stays that have
    begun: the latest admission; the latest start of intensive care and its least length; for the
    exposure clock, the latest exposure and the least length of those that start late enough. So the
    stays, exposures and observations of a patient are swept once in the order of time, in ranges that
    may cut a patient anywhere, and the work grows with their number, not with that of their pairs.
    """
    hour, moment = CLOCKS[clock], F.col("start_date")
    exposure = exposure_from(coded, stays) if exposure is None else exposure
    scored = banded(coded, bands, pressure, pressure_codes)
    scored = scored.groupBy(*STAY, "organ", "start_date").agg(F.max("pat_score").alias("pat_score"))
    latest = exposure.groupBy("patient_num").agg(F.max("mv_init").alias("_exposed"))
    scored = scored.join(latest, "patient_num", "left").where(
        F.col("_exposed").isNull() | (F.col("_exposed") >= shifted_hours(moment, -24))
    )
    if clock == "exposure":
        # exposures come before an observation that is a day later, and the latest of all goes first
        begun = exposure.select(
            "patient_num", shifted_hours(F.col("mv_init"), 24).alias("_at"), F.lit(1).alias("_kind"),
            F.bround("mv_dur_hour").alias("_hours"),
        )
        scored = scored.withColumn("_at", moment).withColumn("_kind", F.lit(0)).unionByName(begun, allowMissingColumns=True)
        scored = running_extremes(scored, ["_at", "_kind"], {}, {"_cap": "_hours"}, ["patient_num"], descending=True)
        scored = scored.where("organ IS NOT NULL").drop("_at", "_kind", "_hours")
    owners = stays.select("patient_num", *PATIENT_ATTRS).distinct()
    seen = scored.join(owners, "patient_num").withColumn("_at", moment).withColumn("_kind", F.lit(1))
    opened = stays.where("hosp_admsn_dttm IS NOT NULL").select(
        "patient_num", *PATIENT_ATTRS, shifted_hours(F.col("hosp_admsn_dttm"), -72).alias("_at"), F.lit(0).alias("_kind"),
        F.col("hosp_admsn_dttm").alias("_admitted"), F.col("icu_stay_start_dttm").alias("_icu"),
        F.bround(F.col("icu_length_of_stay_days") * 24).alias("_icu_hours"),
        F.col("icu_stay_start_dttm").isNull().cast("int").alias("_none"),
    )
    swept = running_extremes(
        seen.unionByName(opened, allowMissingColumns=True),
        ["_at", "_kind"],
        {"_last": "_admitted", "_last_icu": "_icu", "_no_icu": "_none"},
        {"_least_icu": "_icu_hours"},
        ["patient_num", *PATIENT_ATTRS],
    ).where("organ IS NOT NULL AND _last IS NOT NULL")
    # a stay without intensive care has every observation at hour 0 of its clock
    hours = {
        "admit": hours_between(F.col("_last"), moment),
        "icu": F.least(
            F.when(F.col("_no_icu") == 1, F.lit(0.0)).otherwise(F.greatest(hours_between(F.col("_last_icu"), moment), F.lit(0.0))),
            F.col("_least_icu"),
        ),
        "exposure": clamped(hours_between(F.col("_exposed"), moment), F.col("_cap") if clock == "exposure" else F.lit(0.0)),
    }[clock]
    owner = [*STAY, *PATIENT_ATTRS]
    first = F.greatest(hours, F.lit(1.0)).cast("int")
    worst = swept.where(hours <= horizons).groupBy(*owner, "organ", first.alias("_first")).agg(F.max("pat_score").alias("pat_score"))
    worst = (
        worst.withColumn(f"{hour}_cum", F.explode(F.sequence(F.col("_first"), F.lit(horizons))))
        .groupBy(*owner, "organ", f"{hour}_cum")
        .agg(F.max("pat_score").alias("pat_score"))
    )
    return worst.groupBy(*owner, f"{hour}_cum").agg(
        F.sum("pat_score").alias("sofa"), F.count(F.lit(1)).alias("organ_scored")
    )


def initial_score(scored: DataFrame) -> DataFrame:
    """Sum over organs of the first score of each, with the latest hour it was taken at."""
    first = first_per(
        scored,
        [*STAY, "organ"],
        [
            F.col("start_date"),
            F.col("pat_score").desc(),
            F.col("hosp_admsn_dttm"),
            F.col("mv_dur_hour").asc_nulls_last(),
            *(F.col(c) for c in PATIENT_ATTRS),
            *(F.col(c).asc_nulls_last() for c in CLOCKS.values()),
        ],
    )
    return first.groupBy(*STAY, *PATIENT_ATTRS, "mv_dur_hour").agg(
        F.sum("pat_score").alias("sofa_init"),
        F.max("hr_since_admin").alias("sofa_init_since_admin"),
        F.max("hr_since_icu").alias("sofa_init_since_icu"),
    )
