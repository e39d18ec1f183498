"""Every operator as a query over the test tables, with its oracle beside it."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions import scalars as sc
from cohortspark.operators import census as ce
from cohortspark.operators import cohort as co
from cohortspark.operators import compare as cm
from cohortspark.operators import evaluate as ev
from cohortspark.operators import extract as ex
from cohortspark.operators import labs as la
from cohortspark.operators import lookup as lo
from cohortspark.operators import ranks as rk
from cohortspark.operators import reshape as rs
from cohortspark.operators import severity as sv
from cohortspark.operators import sites as si
from cohortspark.operators.regress import fit_glm, fitted
from cohortspark.plans import clinical as cl
from cohortspark.session import checkpointed, shared_folder
from cohortspark.sources import refdata
from cohortspark.sources.batch import Stage, run_batch
from cohortspark.sources.tables import (
    append_table, check_required, drop_tables, empty_table, read_parts, read_table, require_tables, save_snapshot, save_table, stack,
)
from workload.adapters import OBS_SINCE, SINCE, SPAN, YEARS, Views
from workload.registry import ORACLE_TEXTS, STEPS, query, r6

WATERFALL = [co.StatusStep(*s) for s in STEPS]
GROUPS = ["NEG", "PEND", "POS"]
US_LONS, US_LATS = (-124.7, -67.0), (25.1, 49.4)


# ------------------------------------------------------------------- cohort


def status(v: Views) -> DataFrame:
    return co.status_waterfall(v("fx_fact"), v("fx_concept"), WATERFALL, SINCE)


def eligible(v: Views) -> DataFrame:
    return co.eligible_encounters(
        v("fx_enc"), checkpointed(status(v)), v("fx_dx"), v("fx_keys"), SINCE, refdata.STAY_TYPES
    )


def cohort(v: Views) -> DataFrame:
    """The eligible stays as the extracts read them: materialised once."""
    return checkpointed(eligible(v))


@query(
    "concept_path_match",
    r"""SELECT DISTINCT concept_cd FROM $fx_concept
        WHERE concept_path LIKE '%ECONOMY\Brand_2\%' OR concept_path LIKE '%PROMO\Brand_2_\%'""",
)
def _(v):
    return co.concepts_matching(v("fx_concept"), [*STEPS[0][2], *STEPS[2][2]])


query("status_waterfall", "SELECT * FROM $w_status")(status)
query("status_waterfall_stepwise", "SELECT * FROM $w_status")(
    lambda v: co.status_waterfall_stepwise(v("fx_fact"), v("fx_concept"), WATERFALL, SINCE)
)
query("status_waterfall_facts", "SELECT * FROM $w_facts_status")(
    lambda v: co.status_waterfall(v("fx_fact"), v("fx_concept"), WATERFALL, SINCE, dedup=False)
)
query(
    "prefix_code_match",
    """SELECT diagnosisid, dx, icd_key, dx_ccs_grp1, dx_ccs_grp2
       FROM $fx_dx JOIN $fx_keys ON dx LIKE icd_key || '%' WHERE dx_type = '10'""",
)(
    lambda v: co.prefix_matches(
        v("fx_dx").where("dx_type = '10'").select("diagnosisid", "dx"), "dx", v("fx_keys")
    ).select("diagnosisid", "dx", "icd_key", "dx_ccs_grp1", "dx_ccs_grp2")
)
query(
    "prefix_filter",
    """SELECT dx, count(*) AS n FROM $fx_dx
       WHERE dx LIKE 'J1%' OR dx LIKE 'J25%' OR dx LIKE 'J7%' GROUP BY dx""",
)(
    lambda v: v("fx_dx")
    .where(sc.starts_with_any(F.col("dx"), ["J1", "J12", "J25", "J7"]))
    .groupBy("dx")
    .agg(F.count("*").alias("n"))
)
query("eligible_encounters", "SELECT * FROM $w_eligible")(eligible)


@query(
    "cohort_labs_by_status",
    """SELECT e.covid_status, count(*) AS n_labs, count(DISTINCT e.patid) AS n_patients
       FROM $w_eligible e JOIN $fx_lab l ON l.patid = e.patid
        AND l.result_date BETWEEN e.admit_date - 365 AND e.discharge_date + 30
       GROUP BY e.covid_status""",
)
def cohort_labs_by_status(v):
    """The whole way from facts to the labs around each stay, counted by status."""
    labs = ex.extract_events(cohort(v), v("fx_lab"), "lab", keep=["covid_status"])
    return labs.groupBy("covid_status").agg(
        F.count("*").alias("n_labs"), F.count_distinct("patid").alias("n_patients")
    )


# ----------------------------------------------------------------- extracts

for _name, _key in (
    ("labs", "lab"), ("procedures", "px"), ("vitals", "vital"), ("prescriptions", "pmed"),
    ("dispensings", "dmed"), ("med_admin", "amed"),
):
    _spec = ex.EVENT_TABLES[_key]
    _columns = ", ".join(f"t.{c}" for c in _spec.columns)
    _window = (
        f"t.patid = e.patid AND t.{_spec.date} BETWEEN e.admit_date - 365 AND e.discharge_date + 30"
    )
    query(
        f"{_name}_window",
        f"SELECT e.patid, {_columns} FROM $w_eligible e JOIN $fx_{_key} t ON {_window}",
    )(lambda v, key=_key: r6(ex.extract_events(cohort(v), v(f"fx_{key}"), key)))



def fresh_table(v: Views, kind: str) -> str:
    """A name for a stored table; earlier ones of its kind are dropped, so that runs leave one at most."""
    for row in v.spark.sql(f"SHOW TABLES LIKE 'study_{kind}_*'").collect():
        drop_tables(v.spark, row["tableName"])
    return f"study_{kind}_{uuid.uuid4().hex}"


@query("labs_window_stored", ORACLE_TEXTS["labs_window"])
def _(v):
    """The labs around each stay, from a store laid out by quarter and bucketed by patient and quarter."""
    name = fresh_table(v, "labs")
    ex.store_events(v("fx_lab"), name, "result_date", buckets=int(v.spark.conf.get("spark.sql.shuffle.partitions")))
    return r6(ex.extract_events(cohort(v), name, "lab"))


query(
    "labs_window_once",
    f"""SELECT t.patid, {", ".join(f"t.{c}" for c in ex.EVENT_TABLES["lab"].columns)} FROM $fx_lab t
        WHERE EXISTS (SELECT 1 FROM $w_eligible e WHERE t.patid = e.patid
          AND t.result_date BETWEEN e.admit_date - 365 AND e.discharge_date + 30)""",
)(lambda v: r6(ex.extract_events(cohort(v), v("fx_lab"), "lab", per_stay=False)))
query(
    "obs_clin_window",
    """SELECT e.patid, o.encounter_num AS encounterid, o.start_date AS obsclin_date_time,
              o.nval_num AS obsclin_result_num, o.tval_char AS obsclin_result_text,
              c.obsclin_type, c.obsclin_code, c.raw_obsclin_name
       FROM $w_eligible e JOIN $fx_fact o ON o.patient_num = e.patid
       JOIN $fx_obs_codes c ON c.i2b2_code = o.concept_cd
       WHERE o.start_date BETWEEN e.admit_date - 30 AND e.discharge_date + 30""",
)(lambda v: ex.extract_observations(cohort(v), v("fx_fact"), v("fx_obs_codes")))



@query(
    "code_map_facts",
    f"""SELECT c.raw_obsclin_name, c.obsclin_code, NOT regexp_matches(c.i2b2_code, '[|:]') AS misplaced,
              count(*) AS n_facts, count(DISTINCT f.patient_num) AS n_patients
       FROM $fx_fact f JOIN $w_local_codes k ON cast(substr(f.concept_cd, 3) AS bigint) % {len(refdata.OBSERVATION_CODES)} = k.k
       JOIN (SELECT DISTINCT raw_obsclin_name, obsclin_code, obsclin_type, i2b2_code, i2b2_label FROM $w_local_codes) c
         ON c.i2b2_code = k.i2b2_code
       GROUP BY ALL""",
)
def _(v):
    """Facts under a site's codes, dealt by part, through its code map; rows whose code cannot be one are marked."""
    codes = refdata.observation_codes(v.spark)
    dealt = [(k, row[3]) for k, row in enumerate(refdata.OBSERVATION_CODES)]
    site = refdata.literal_table(v.spark, dealt, "k int, i2b2_code string")
    part = F.substring(F.col("concept_cd"), 3, 20).cast("long") % len(dealt)
    facts = v("fx_fact").select("patient_num", part.cast("int").alias("k")).join(site, "k")
    odd = refdata.misplaced_codes(codes).withColumn("misplaced", F.lit(True))
    marked = codes.join(odd, codes.columns, "left").withColumn("misplaced", F.coalesce("misplaced", F.lit(False)))
    return (
        facts.join(marked, "i2b2_code")
        .groupBy("raw_obsclin_name", "obsclin_code", "misplaced")
        .agg(F.count("*").alias("n_facts"), F.count_distinct("patient_num").alias("n_patients"))
    )


_DEMO = "SELECT e.patid, d.birth_date, d.sex, d.race, d.hispanic, x.death_date"
query(
    "demo_death",
    f"{_DEMO} FROM $w_eligible e JOIN $fx_demo d ON d.patid = e.patid LEFT JOIN $fx_death x ON x.patid = e.patid",
)(lambda v: ex.demographics(cohort(v), v("fx_demo"), v("fx_death")))
query(
    "demo_deceased",
    f"{_DEMO} FROM $w_eligible e JOIN $fx_demo d ON d.patid = e.patid JOIN $fx_death x ON x.patid = e.patid",
)(lambda v: ex.demographics(cohort(v), v("fx_demo"), v("fx_death"), deceased_only=True))
query(
    "demo_once",
    """SELECT d.patid, d.birth_date, d.sex, d.race, d.hispanic, x.death_date
       FROM $fx_demo d LEFT JOIN $fx_death x ON x.patid = d.patid
       WHERE d.patid IN (SELECT patid FROM $w_eligible)""",
)(lambda v: ex.demographics(cohort(v), v("fx_demo"), v("fx_death"), per_stay=False))
_DX = "patid, d.encounterid, diagnosisid, dx, dx_date, pdx, dx_type, dx_source, dx_origin"
query(
    "dx_history",
    f"SELECT e.{_DX} FROM $w_eligible e JOIN $fx_dx d ON d.patid = e.patid",
)(lambda v: ex.diagnosis_history(cohort(v), v("fx_dx"), per_stay=True))
query(
    "dx_history_once",
    f"SELECT d.{_DX} FROM $fx_dx d WHERE patid IN (SELECT patid FROM $w_eligible)",
)(lambda v: ex.diagnosis_history(cohort(v), v("fx_dx")))


@query(
    "case_control_stack",
    """SELECT patient_num, encounter_num, pos_confirmed, hosp_admsn_dttm AS infection_start_dttm,
              age_at_admit AS age_at_inf FROM $fx_stay WHERE pos_confirmed > 0
       UNION ALL
       SELECT patient_num, encounter_num, pos_confirmed, TIMESTAMP '1900-01-01', NULL
       FROM $fx_stay WHERE pos_confirmed = 0""",
)
def _(v):
    stay = v("fx_stay").select(
        "patient_num", "encounter_num", "pos_confirmed", "hosp_admsn_dttm", "age_at_admit"
    )
    cases = stay.where("pos_confirmed > 0").select(
        "patient_num", "encounter_num", "pos_confirmed",
        F.col("hosp_admsn_dttm").alias("infection_start_dttm"),
        F.col("age_at_admit").alias("age_at_inf"),
    )
    controls = stay.where("pos_confirmed = 0").drop("hosp_admsn_dttm", "age_at_admit")
    return co.case_control_stack(cases, controls)


query(
    "cohort_semi_join",
    """SELECT concept_cd, count(*) AS n FROM $fx_fact
       WHERE patient_num IN (SELECT patient_num FROM $w_status) GROUP BY concept_cd""",
)(
    lambda v: co.in_cohort(v("fx_fact"), checkpointed(status(v)), ["patient_num"])
    .groupBy("concept_cd")
    .agg(F.count("*").alias("n"))
)


# -------------------------------------------------------- paging and batches

_DIGIT = "cast(substr(lpad(cast(l_orderkey AS varchar), 6, '0'), 3, {0}) AS int)"
query(
    "key_digit_chunk",
    f"""SELECT {_DIGIT.format(1)} AS chunk, count(*) AS n, count(DISTINCT l_orderkey) AS n_keys,
               sum(l_quantity) AS quantity
        FROM $lineitem GROUP BY 1""",
)(
    lambda v: v("lineitem")
    .groupBy(sc.key_digits(F.col("l_orderkey")).alias("chunk"))
    .agg(
        F.count("*").alias("n"),
        F.count_distinct("l_orderkey").alias("n_keys"),
        F.sum("l_quantity").alias("quantity"),
    )
)
query(
    "key_digit_sample",
    f"SELECT l_orderkey, l_linenumber, l_partkey FROM $lineitem WHERE {_DIGIT.format(3)} = 4",
)(
    lambda v: rk.key_digit_chunk(
        v("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", 4, digits=3
    )
)
_PAGED = """SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS page
            FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM $orders)"""


def _order_columns(v: Views) -> DataFrame:
    return v("orders").select("o_orderkey", "o_custkey", "o_totalprice")


query("row_page", f"SELECT o_orderkey, o_custkey, o_totalprice FROM ({_PAGED}) WHERE page = 3")(
    lambda v: rk.row_page(_order_columns(v), ["o_orderkey"], 3)
)
query(
    "row_pages",
    f"""SELECT page, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
        FROM ({_PAGED}) GROUP BY page""",
)(
    lambda v: rk.row_pages(_order_columns(v), ["o_orderkey"])
    .groupBy("page")
    .agg(
        F.count("*").alias("n"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )
)


@query(
    "sql_batch",
    """SELECT f.concept_cd, count(*) AS n_facts, count(DISTINCT f.patient_num) AS n_patients
       FROM $fx_fact f JOIN (SELECT o_custkey FROM $orders WHERE o_orderdate >= DATE '1998-01-01'
                             GROUP BY o_custkey HAVING count(*) >= 7) b ON f.patient_num = b.o_custkey
       GROUP BY f.concept_cd""",
)
def _(v):
    v("orders").createOrReplaceTempView("batch_orders")
    v("fx_fact").createOrReplaceTempView("batch_facts")
    stages = [
        Stage(
            "batch_busy",
            "SELECT o_custkey FROM IDENTIFIER(:orders) WHERE o_orderdate >= :since"
            " GROUP BY o_custkey HAVING count(*) >= :least",
        ),
        Stage(
            "batch_report",
            "SELECT concept_cd, count(*) AS n_facts, count(DISTINCT patient_num) AS n_patients"
            " FROM batch_facts JOIN batch_busy ON patient_num = o_custkey GROUP BY concept_cd",
            "query",
        ),
    ]
    params = {"orders": "batch_orders", "since": dt.date.fromisoformat(SINCE), "least": 7}
    return run_batch(v.spark, stages, params)["batch_report"]


@query(
    "status_loads",
    """SELECT DISTINCT 0 AS step, * FROM $w_step0 UNION ALL SELECT DISTINCT 1, * FROM $w_step1
       UNION ALL SELECT DISTINCT 2, * FROM $w_step2 UNION ALL SELECT DISTINCT 3, * FROM $w_step3""",
)
def _(v):
    """The status waterfall loaded step by step into one table, the whole batch twice.

    All eight loads read the facts since the floor date of the concepts of any step, which are stored once for them.
    """
    held = fresh_table(v, "facts")
    paths = [F.like("concept_path", F.lit(path), F.lit("!")) for _, _, (path,) in STEPS]
    codes = v("fx_concept").where(reduce(Column.__or__, paths)).select("concept_cd")
    facts = v("fx_fact").where(sc.not_before(v("fx_fact"), "start_date", SINCE))
    facts = facts.select("patient_num", "encounter_num", "concept_cd", "start_date").join(codes, "concept_cd", "left_semi")
    save_table(facts, held).createOrReplaceTempView("load_facts")
    v("fx_concept").createOrReplaceTempView("load_concepts")
    name = fresh_table(v, "status")
    earlier = " AND NOT EXISTS (SELECT 1 FROM IDENTIFIER(:loads) l WHERE l.patient_num = f.patient_num AND l.step < {step})"
    stages = [
        Stage(
            name,
            f"""SELECT DISTINCT patient_num, encounter_num, {status} AS pos_confirmed, {lab} AS lab_int
                FROM load_facts f JOIN (SELECT DISTINCT concept_cd FROM load_concepts
                                        WHERE concept_path LIKE r'{pattern}' ESCAPE '!') USING (concept_cd)
                WHERE start_date >= TIMESTAMP_NTZ '{SINCE}'""" + (earlier.format(step=step) if step else ""),
            "load",
            ("step", step),
        )
        for step, (status, lab, (pattern,)) in enumerate(STEPS)
    ]
    for _ in range(2):
        loaded = run_batch(v.spark, stages, {"loads": name})[name]
    drop_tables(v.spark, held)
    return loaded.select("step", "patient_num", "encounter_num", "pos_confirmed", "lab_int")


@query("study_round_trip", "SELECT * FROM $fx_demo")
def _(v):
    """Demographics through a table that is written, added to, checked, saved in parts, read back and dropped."""
    people, name = v("fx_demo"), fresh_table(v, "people")
    save_table(people.where("patid % 2 = 0"), name, bucket_by=["patid"], buckets=4)
    append_table(people.where("patid % 2 <> 0"), name)
    require_tables(v.spark, name)
    folder = f"{shared_folder(v.spark)}/{name}"
    whole = read_table(v.spark, "catalog", name)
    save_snapshot(whole.where("race <= 'F'"), f"{folder}/1")
    save_snapshot(whole.where("race > 'F' OR race IS NULL"), f"{folder}/2")
    drop_tables(v.spark, name)
    loaded = stack([empty_table(v.spark, people.schema), read_parts(v.spark, [f"{folder}/1", f"{folder}/2"])])
    return check_required(loaded, people.schema)


query(
    "calendar_ranks_years",
    """SELECT date_scale, date_rk, count(*) AS n, min(o_orderdate) AS first_day
       FROM (SELECT cast(o_orderdate AS date) AS o_orderdate FROM $orders) JOIN $w_calendar_years ON o_orderdate = date
       GROUP BY date_scale, date_rk""",
)(
    lambda v: v("orders")
    .withColumn("date", F.to_date("o_orderdate"))
    .join(refdata.calendar(v.spark, *YEARS), "date")
    .groupBy("date_scale", "date_rk")
    .agg(F.count("*").alias("n"), F.min("date").alias("first_day"))
)
query(
    "calendar_ranks",
    """SELECT date_scale, date_rk, count(*) AS n, min(cast(ts AS date)) AS first_day
       FROM $events JOIN $w_calendar ON cast(ts AS date) = date GROUP BY date_scale, date_rk""",
)(
    lambda v: v("events")
    .withColumn("date", F.to_date("ts"))
    .join(refdata.calendar(v.spark, *SPAN), "date")
    .groupBy("date_scale", "date_rk")
    .agg(F.count("*").alias("n"), F.min("date").alias("first_day"))
)


# ----------------------------------------------------------------- severity


def coded_obs(v: Views) -> DataFrame:
    codes = v("fx_code_map").withColumnRenamed("i2b2_code", "concept_cd")
    return v("fx_obs").join(codes, "concept_cd")


def severity(v: Views, grain: str = "patient") -> cl.SeverityResult:
    return cl.score_severity(v("fx_obs"), v("fx_stay"), v("fx_code_map"), OBS_SINCE, grain=grain)


def initial(v: Views) -> DataFrame:
    return severity(v).initial


query(
    "band_score",
    "SELECT patient_num, encounter_num, code, start_date, nval_num, organ, pat_score FROM $w_banded",
)(
    lambda v: sv.band_score(coded_obs(v), refdata.severity_bands(v.spark)).select(
        "patient_num", "encounter_num", "code", "start_date", "nval_num", "organ", "pat_score"
    )
)
query(
    "band_lint",
    """SELECT code, count(*) AS n_obs, count(*) FILTER (hits = 0) AS n_unscored,
              count(*) FILTER (hits = 1) AS n_once, count(*) FILTER (hits > 1) AS n_multi
       FROM (SELECT c.code, c.patient_num, c.start_date, c.nval_num, any_value(h.hits) AS hits
             FROM $w_coded c JOIN (
               SELECT x.code, x.nval_num, count(b.pat_score) AS hits
               FROM (SELECT DISTINCT code, nval_num FROM $w_coded
                     WHERE code IN (SELECT code FROM $w_bands)) x
               LEFT JOIN (SELECT DISTINCT code, nval_num, pat_score FROM $w_banded) b
                 ON x.code = b.code AND x.nval_num = b.nval_num GROUP BY ALL) h
             ON c.code = h.code AND c.nval_num = h.nval_num
             GROUP BY c.code, c.patient_num, c.start_date, c.nval_num)
       GROUP BY code""",
)(lambda v: sv.band_coverage(coded_obs(v), refdata.severity_bands(v.spark)))
query("exposure_duration", "SELECT * FROM $w_mv")(
    lambda v: sv.exposure_duration(v("fx_obs"), v("fx_stay"), v("fx_code_map"), OBS_SINCE)
)
query(
    "derived_map",
    """SELECT patient_num, encounter_num, instance_num, start_date, sbp, dbp,
              CASE WHEN sbp IS NOT NULL AND dbp IS NOT NULL THEN round_even((2 * dbp + sbp) / 3, 0)
                   ELSE map END AS map, dup_cells
       FROM (SELECT patient_num, encounter_num, instance_num, start_date,
                    max(nval_num) FILTER (concept_cd = 'BP|1') AS sbp,
                    max(nval_num) FILTER (concept_cd = 'BP|2') AS dbp,
                    max(nval_num) FILTER (concept_cd = 'BP|3') AS map,
                    cast((count(DISTINCT nval_num) FILTER (concept_cd = 'BP|1') > 1) AS int)
                    + cast((count(DISTINCT nval_num) FILTER (concept_cd = 'BP|2') > 1) AS int)
                    + cast((count(DISTINCT nval_num) FILTER (concept_cd = 'BP|3') > 1) AS int) AS dup_cells
             FROM $fx_bp JOIN $fx_bp_stay USING (patient_num, encounter_num)
             WHERE start_date >= TIMESTAMP '1998-01-01' GROUP BY ALL)
       WHERE map IS NOT NULL OR (sbp IS NOT NULL AND dbp IS NOT NULL)""",
)(
    lambda v: sv.derived_map(
        v("fx_bp"), v("fx_bp_stay"), v("fx_bp_codes"), SINCE, count_duplicates=True
    )
)
_SCORED = """patient_num, encounter_num, code, start_date, nval_num, organ, pat_score, pos_confirmed,
    hosdead, age_at_admit, sex_female, hosp_admsn_dttm, mv_init, mv_dur_hour, hr_since_admin,
    hr_since_icu, hr_since_mv"""
query("scored_observations", f"SELECT {_SCORED} FROM $w_scored")(
    lambda v: severity(v).scored.select(*_SCORED.replace("\n", " ").replace(" ", "").split(","))
)
query(
    "scored_by_encounter",
    """SELECT b.patient_num, b.encounter_num, b.code, b.start_date, b.organ, b.pat_score,
              round_even(cast(date_diff('microsecond', s.hosp_admsn_dttm, b.start_date) AS double) / 3.6e9, 0)
                AS hr_since_admin
       FROM $w_banded_once b JOIN $fx_stay s USING (patient_num, encounter_num)
       LEFT JOIN $w_mv v ON b.patient_num = v.patient_num
       WHERE b.start_date >= s.hosp_admsn_dttm - INTERVAL 72 HOUR
         AND (v.mv_init IS NULL OR v.mv_init >= b.start_date - INTERVAL 24 HOUR)""",
)(
    lambda v: severity(v, "encounter").scored.select(
        "patient_num", "encounter_num", "code", "start_date", "organ", "pat_score", "hr_since_admin"
    )
)
for _clock, _hour in sv.CLOCKS.items():
    query(
        f"worst_by_horizon_{_clock}",
        f"""SELECT patient_num, encounter_num, pos_confirmed, hosdead, age_at_admit, sex_female,
                   {_hour}, sofa, organ_scored, k AS {_hour}_cum
            FROM (SELECT patient_num, encounter_num, pos_confirmed, hosdead, age_at_admit, sex_female,
                         {_hour}, cast(sum(s) AS bigint) AS sofa, count(DISTINCT organ) AS organ_scored
                  FROM (SELECT patient_num, encounter_num, organ, hr_since_admin, hr_since_icu, hr_since_mv,
                               pos_confirmed, hosdead, age_at_admit, sex_female, max(pat_score) AS s
                        FROM $w_scored GROUP BY ALL)
                  GROUP BY ALL)
            JOIN (SELECT unnest(range(1, 13))::INT AS k) ks ON {_hour} <= k""",
    )(lambda v, clock=_clock: severity(v).horizons[clock])
for _name, _clock in (("", "admit"), ("_icu", "icu"), ("_exposure", "exposure")):
    _hour = sv.CLOCKS[_clock]

    @query(
        f"worst_by_horizon_cumulative{_name}",
        f"""SELECT patient_num, encounter_num, pos_confirmed, hosdead, age_at_admit, sex_female,
              k AS {_hour}_cum, cast(sum(s) AS bigint) AS sofa, count(*) AS organ_scored
       FROM (SELECT patient_num, encounter_num, pos_confirmed, hosdead, age_at_admit, sex_female, organ,
                    k, max(pat_score) AS s
             FROM $w_scored JOIN (SELECT unnest(range(1, 13))::INT AS k) ks ON {_hour} <= k
             GROUP BY ALL) GROUP BY ALL""",
    )
    def _(v, clock=_clock):
        coded = checkpointed(sv.coded_facts(v("fx_obs"), v("fx_stay"), v("fx_code_map"), OBS_SINCE))
        return sv.cumulative_by_horizon(coded, v("fx_stay"), refdata.severity_bands(v.spark), clock)


query("initial_score", "SELECT * FROM $w_initial")(initial)

for _margin in ("row", "col"):
    query(
        f"crosstab_{_margin}",
        f"""SELECT r.row, c.col, coalesce(n, 0) AS n,
                   round(cast(coalesce(n, 0) AS double) / sum(coalesce(n, 0)) OVER (PARTITION BY {_margin[0]}.{_margin}), 6)
                     AS prop
            FROM (SELECT DISTINCT hosdead AS row FROM $w_initial) r
            CROSS JOIN (SELECT DISTINCT sofa_init AS col FROM $w_initial) c
            LEFT JOIN (SELECT hosdead AS row, sofa_init AS col, count(*) AS n FROM $w_initial GROUP BY ALL) x
              ON x.row = r.row AND x.col = c.col""",
    )(lambda v, margin=_margin: r6(rs.crosstab(initial(v), "hosdead", "sofa_init", margin)))
query(
    "score_quantiles",
    """SELECT round(quantile_cont(sofa_init_since_admin, 0.5), 6) AS q50,
              round(quantile_cont(sofa_init_since_admin, 0.8), 6) AS q80,
              round(quantile_cont(sofa_init_since_admin, 0.9), 6) AS q90,
              round(quantile_cont(sofa_init_since_admin, 0.95), 6) AS q95 FROM $w_initial""",
)(
    lambda v: r6(
        rk.exact_quantiles(
            initial(v), "sofa_init_since_admin", {"q50": 0.5, "q80": 0.8, "q90": 0.9, "q95": 0.95}
        )
    )
)


query(
    "score_quantiles_icu",
    """SELECT round(quantile_cont(sofa_init_since_icu, 0.5), 6) AS q50,
              round(quantile_cont(sofa_init_since_icu, 0.9), 6) AS q90 FROM $w_initial
       WHERE sofa_init_since_icu IS NOT NULL""",
)(lambda v: r6(rk.exact_quantiles(initial(v), "sofa_init_since_icu", {"q50": 0.5, "q90": 0.9})))
query(
    "crosstab_status",
    """SELECT r.row, c.col, coalesce(n, 0) AS n,
              round(cast(coalesce(n, 0) AS double) / sum(coalesce(n, 0)) OVER (PARTITION BY c.col), 6) AS prop
       FROM (SELECT DISTINCT hosdead AS row FROM $w_initial) r
       CROSS JOIN (SELECT DISTINCT pos_confirmed AS col FROM $w_initial) c
       LEFT JOIN (SELECT hosdead AS row, pos_confirmed AS col, count(*) AS n FROM $w_initial GROUP BY ALL) x
         ON x.row = r.row AND x.col = c.col""",
)(lambda v: r6(rs.crosstab(initial(v), "hosdead", "pos_confirmed", "col")))
query(
    "band_issues",
    """SELECT p.code, value, CASE WHEN hits = 0 THEN 'gap' ELSE 'overlap' END AS issue, n AS n_obs
       FROM (SELECT p.code, value, count(*) FILTER (
                      CASE WHEN direction = 'l' THEN value < ub WHEN direction = 'le' THEN value <= ub
                           WHEN direction = 'g' THEN value > lb
                           WHEN scale_type = 'c' THEN value >= lb AND value < ub
                           ELSE value >= lb AND value <= ub END) AS hits
             FROM (SELECT DISTINCT code, value FROM (
                     SELECT code, edge AS value FROM $w_band_edges
                     UNION ALL SELECT code, (edge + lead(edge) OVER (PARTITION BY code ORDER BY edge)) / 2
                     FROM $w_band_edges) WHERE value IS NOT NULL) p
             JOIN $w_bands b ON b.code = p.code GROUP BY p.code, value) p
       JOIN (SELECT code, count(*) AS n FROM $w_coded GROUP BY code) o ON o.code = p.code
       WHERE hits <> 1""",
)(
    lambda v: sv.band_lint(refdata.severity_bands(v.spark)).join(
        coded_obs(v).groupBy("code").agg(F.count("*").alias("n_obs")), "code"
    )
)


# --------------------------------------------------------------------- labs


def lab_values(v: Views) -> DataFrame:
    return la.lab_values(v("fx_wbc"), refdata.white_cell_ranges(v.spark))


def lab_all(v: Views) -> DataFrame:
    return la.lab_engineered(lab_values(v), refdata.white_cell_ranges(v.spark))


_LAB = (
    "SELECT patient_num, encounter_num, wbc_type, component_id, round(nval_num, 6) AS nval_num,"
    " units, start_date, start_since_lab"
)
query("lab_values", f"{_LAB} FROM $w_lab")(lambda v: r6(lab_values(v)))
query("lab_percent", f"{_LAB} FROM $w_lab_perc")(lambda v: r6(la.lab_percent(lab_values(v))))
query("lab_ratio_lymph", f"{_LAB} FROM $w_lab_lymph")(
    lambda v: r6(la.lab_ratio(lab_values(v), "Lymphocyte"))
)
query("lab_ratio_neut", f"{_LAB} FROM $w_lab_neut")(
    lambda v: r6(la.lab_ratio(lab_values(v), "Neutrophils"))
)
query("lab_flags", f"{_LAB}, nval_fac FROM $w_lab_all")(lambda v: r6(lab_all(v)))
query("lab_initial", f"{_LAB}, nval_fac FROM $w_lab_first")(lambda v: r6(la.lab_initial(lab_all(v))))
query(
    "lab_quantiles",
    "SELECT wbc_type, units, "
    + ", ".join(f"round(quantile_cont(nval_num, {p}), 6) AS {n}" for n, p in la.QUANTILES.items())
    + " FROM $w_lab_first GROUP BY wbc_type, units",
)(lambda v: r6(la.lab_quantiles(la.lab_initial(lab_all(v)))))
query("lab_encounters", "SELECT count(DISTINCT encounter_num) AS n FROM $w_lab_first")(
    lambda v: la.lab_initial(lab_all(v)).agg(F.count_distinct("encounter_num").alias("n"))
)


# ------------------------------------------------------------------- census


def features(v: Views) -> DataFrame:
    return ce.with_stay_features(v("fx_stay"))


def _incidence_sql(start: str, scale: str, by: str) -> str:
    return f"""SELECT date_rk, {by} count(DISTINCT encounter_num) AS confirmed, min(date) AS date_to_match
        FROM $w_features JOIN $w_calendar ON cast({start} AS date) = date
        WHERE date_scale = '{scale}' GROUP BY ALL"""


def _census_sql(start: str, length: str) -> str:
    return f"""SELECT date_rk, adt_pat_class, count(DISTINCT encounter_num) AS confirmed,
               min(date) AS date_to_match
        FROM (SELECT encounter_num, adt_pat_class, cast({start} AS date) + cast(k AS int) AS day
              FROM (SELECT *, unnest(range(1, cast(greatest(trunc({length}), 1) AS bigint) + 1)) AS k
                    FROM $w_features WHERE pos_confirmed > 0 AND {length} IS NOT NULL))
        JOIN $w_calendar ON day = date WHERE date_scale = 'date_daily' GROUP BY ALL"""


query(
    "stay_features",
    "SELECT patient_num, encounter_num, adt_pat_class, hosp_los, icu_ind FROM $w_features",
)(
    lambda v: features(v).select(
        "patient_num", "encounter_num", "adt_pat_class", "hosp_los", "icu_ind"
    )
)
query("admission_incidence", _incidence_sql("hosp_admsn_dttm", "date_week", "adt_pat_class,"))(
    lambda v: ce.incidence(features(v), SPAN)
)
query("icu_incidence", _incidence_sql("icu_stay_start_dttm", "date_week", ""))(
    lambda v: ce.icu_incidence(features(v), SPAN)
)
query("inpatient_census", _census_sql("hosp_admsn_dttm", "hosp_los"))(
    lambda v: ce.census(features(v), SPAN)
)
query("icu_census", _census_sql("icu_stay_start_dttm", "icu_length_of_stay_days"))(
    lambda v: ce.icu_census(features(v), SPAN)
)
query(
    "stay_days",
    """SELECT encounter_num, k AS day, cast(hosp_admsn_dttm AS date) + cast(k AS int) AS date_to_match
       FROM (SELECT *, cast(unnest(range(1, cast(greatest(trunc(hosp_los), 1) AS bigint) + 1)) AS int) AS k
             FROM $w_features WHERE hosp_los IS NOT NULL)""",
)(lambda v: ce.stay_days(features(v), "hosp_admsn_dttm", "hosp_los", SPAN, "encounter_num"))
query("los_max", "SELECT max(hosp_los) AS los_max FROM $w_features WHERE pos_confirmed > 0")(
    lambda v: features(v).where("pos_confirmed > 0").agg(F.max("hosp_los").alias("los_max"))
)
query(
    "los_summary",
    """SELECT min(hosp_admsn_dttm) AS first_admission, max(hosp_admsn_dttm) AS last_admission,
              min(hosp_los) AS los_min, round(avg(hosp_los), 6) AS los_mean, max(hosp_los) AS los_max,
              round(stddev_samp(hosp_los), 6) AS los_sd, quantile_cont(hosp_los, 0.25) AS los_q1,
              quantile_cont(hosp_los, 0.5) AS los_median, quantile_cont(hosp_los, 0.75) AS los_q3
       FROM $w_longest""",
)(lambda v: r6(ce.los_summary(features(v))))
query(
    "los_buckets",
    """SELECT los_grp, pat_n, enc_n, count(DISTINCT patient_num) AS pat_cnt,
              count(DISTINCT encounter_num) AS enc_cnt
       FROM (SELECT *, CASE WHEN hosp_los <= 4 THEN '1-4' WHEN hosp_los <= 28 THEN '5-28' ELSE '28up' END
                      AS los_grp FROM $w_longest)
       CROSS JOIN (SELECT count(DISTINCT patient_num) AS pat_n, count(DISTINCT encounter_num) AS enc_n
                   FROM $w_longest)
       GROUP BY ALL""",
)(lambda v: ce.los_buckets(features(v)))
query(
    "age_trend",
    """SELECT date_rk, icu_ind, date_to_match, pat_cnt, age_median, age_q1, age_q3,
              cast(pat_cnt AS varchar) || ',' || regexp_replace(cast(age_median AS varchar), '[.]0$', '')
                AS label
       FROM (SELECT date_rk, icu_ind, min(date) AS date_to_match, count(DISTINCT patient_num) AS pat_cnt,
                    quantile_cont(age_at_admit, 0.5) AS age_median, quantile_cont(age_at_admit, 0.25) AS age_q1,
                    quantile_cont(age_at_admit, 0.75) AS age_q3
             FROM $w_features JOIN $w_calendar ON cast(hosp_admsn_dttm AS date) = date
             WHERE date_scale = 'date_biweek' GROUP BY ALL)""",
)(lambda v: ce.age_trend(features(v), SPAN))


# --------------------------------------------------------------- comparison


def demo(v: Views) -> DataFrame:
    stay = v("fx_stay")
    return cl.demographic_stack(stay.where("pos_confirmed > 0"), stay.where("pos_confirmed = 0"))


NUMERIC = ["age_at_admit", "icu_length_of_stay_days"]
CATEGORICAL = ["sex_female", "icu_ind", "disch_disp_grp", "admsn_dx_grp"]


def long_numbers(v: Views) -> DataFrame:
    return rs.gather(demo(v).withColumnRenamed("pos_confirmed", "grp"), ["grp"], NUMERIC, "double")


def cells(v: Views) -> DataFrame:
    renamed = demo(v).withColumnRenamed("pos_confirmed", "grp")
    return cm.contingency(rs.gather(renamed, ["grp"], CATEGORICAL, "string"))


_DEMO_COLUMNS = [
    "patient_num", "encounter_num", "pos_confirmed", "sex_female", "age_at_admit",
    "icu_length_of_stay_days", "icu_ind", "disch_disp_grp", "admsn_dx_grp",
]
query(
    "demo_stack",
    "SELECT "
    + ", ".join(c if "length" not in c else f"round({c}, 6) AS {c}" for c in _DEMO_COLUMNS)
    + " FROM $w_demo",
)(lambda v: r6(demo(v).select(*_DEMO_COLUMNS)))
query(
    "disposition_group",
    """SELECT disch_disp_grp, admsn_dx_grp, count(*) AS n FROM $w_demo
       GROUP BY disch_disp_grp, admsn_dx_grp""",
)(lambda v: demo(v).groupBy("disch_disp_grp", "admsn_dx_grp").agg(F.count("*").alias("n")))
query(
    "numeric_profile",
    """SELECT var, grp, n, val_miss, round(val_mean, 6) AS val_mean, round(val_sd, 6) AS val_sd,
              round(val_med, 6) AS val_med, round(val_q1, 6) AS val_q1, round(val_q3, 6) AS val_q3,
              round(val_min, 6) AS val_min, round(val_max, 6) AS val_max FROM $w_num""",
)(lambda v: r6(cm.numeric_profile(demo(v), "patient_num", "pos_confirmed", NUMERIC).drop("label")))
query("categorical_profile", "SELECT var, grp, val, tot, val_miss, n, prop FROM $w_cat")(
    lambda v: cm.categorical_profile(demo(v), "patient_num", "pos_confirmed", CATEGORICAL).drop("label")
)
_ANOVA = """SELECT var, k - 1 AS df1, cast(nn - k AS bigint) AS df2, (ssb / (k - 1)) / (ssw / (nn - k)) AS f_value
       FROM (SELECT var, count(*) AS k, sum(n) AS nn, sum(n * power(m - g, 2)) AS ssb,
                    sum((n - 1) * s) AS ssw
             FROM (SELECT var, grp, count(val) AS n, avg(val) AS m, coalesce(var_samp(val), 0) AS s
                   FROM $w_demo_num WHERE val IS NOT NULL GROUP BY var, grp)
             JOIN (SELECT var, avg(val) AS g FROM $w_demo_num GROUP BY var) USING (var)
             GROUP BY var)"""
# with three groups the tail of F has a closed form
_ANOVA_P = f"SELECT var, f_value, power(1 + 2 * f_value / df2, -df2 / 2.0) AS p_value FROM ({_ANOVA}) WHERE df1 = 2"
query("anova_f", f"SELECT var, df1, df2, round(f_value, 6) AS f_value FROM ({_ANOVA})")(
    lambda v: r6(cm.anova(cm.group_moments(long_numbers(v))).select("var", "df1", "df2", "f_value"))
)
query("anova_p", f"SELECT var, round(f_value, 6) AS f_value, round(p_value, 6) AS p_value FROM ({_ANOVA_P})")(
    lambda v: r6(cm.anova_p(cm.anova(cm.group_moments(long_numbers(v)))).select("var", "f_value", "p_value"))
)
_CHISQ = """SELECT r.var, sum(power(coalesce(o.o, 0) - r * c / t, 2) / (r * c / t)) AS chisq,
              (count(DISTINCT r.val) - 1) * (count(DISTINCT c.grp) - 1) AS df,
              cast(any_value(t) AS bigint) AS total, min(r * c / t) AS least
       FROM $w_cell_rows r JOIN $w_cell_cols c ON r.var = c.var
       JOIN (SELECT var, sum(o) AS t FROM $w_cells GROUP BY ALL) t ON r.var = t.var
       LEFT JOIN $w_cells o ON o.var = r.var AND o.val = r.val AND o.grp = c.grp GROUP BY r.var"""
query("chisq_stat", f"SELECT var, round(chisq, 6) AS chisq, df, total FROM ({_CHISQ})")(
    lambda v: r6(cm.chi_square(cells(v)))
)


def simulated(v: Views) -> DataFrame:
    """Statistic and whether the simulated p lies within four standard errors of the limit's.

    Only where the limit holds: every expected count is five or more. With an even number of degrees
    of freedom, as always with three groups, the limit's tail is a finite sum.
    """
    found = cells(v)
    sizes = found.groupBy("var", "val").agg(F.sum("o").alias("r")).groupBy("var").agg(F.min("r").alias("r"))
    groups = found.groupBy("var", "grp").agg(F.sum("o").alias("c")).groupBy("var").agg(F.min("c").alias("c"))
    half = F.col("chisq") / 2
    terms = F.transform(F.sequence(F.lit(0), (F.col("df") / 2 - 1).cast("int")), lambda k: F.pow(half, k) / F.factorial(k))
    tail = F.exp(-half) * F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    draws = 2000
    slack = 4 * F.sqrt(F.col("tail") * (1 - F.col("tail")) / draws) + 2.0 / draws
    return (
        cm.chi_square(found)
        .where("df > 0 and df % 2 = 0")
        .join(cm.chi_square_p(found, draws), "var")
        .join(sizes, "var")
        .join(groups, "var")
        .withColumn("tail", tail)
        .withColumn("agrees", F.when(F.col("r") * F.col("c") / F.col("total") >= 5, F.abs(F.col("p_value") - F.col("tail")) <= slack))
        .select("var", "chisq", "df", "tail", "agrees")
    )


query(
    "chisq_mc",
    f"""SELECT var, round(chisq, 6) AS chisq, df, CASE WHEN least >= 5 THEN true END AS agrees
        FROM ({_CHISQ}) WHERE df > 0 AND df % 2 = 0""",
)(lambda v: r6(simulated(v).drop("tail")))


def _text(x: str, digits: int) -> str:
    """DuckDB text of a rounded number without trailing zeros."""
    number = f"printf('%.{digits}f', round_even(cast({x} AS double), {digits}))"
    return f"CASE WHEN {x} IS NULL THEN 'NA' ELSE regexp_replace({number}, '[.]?0+$', '') END"


_REPORT = f"""SELECT var, cat, max(cell) FILTER (grp = 'NEG') AS "NEG", max(cell) FILTER (grp = 'PEND') AS "PEND",
               max(cell) FILTER (grp = 'POS') AS "POS"
        FROM (SELECT 'n' AS var, '' AS cat, grp, cast(n AS varchar) AS cell FROM $w_num
              UNION SELECT var, 'mean(sd) [miss]', grp,
                {_text("val_mean", 1)} || ' (' || {_text("val_sd", 1)} || ') ['
                || {_text("(val_miss / n)", 2)} || ']' FROM $w_num
              UNION SELECT var, val || ',n(%) [miss]', grp,
                cast(n AS varchar) || ' (' || {_text("(prop * 100)", 1)} || '%) ['
                || {_text("(val_miss / tot)", 2)} || ']' FROM $w_cat)
        GROUP BY var, cat"""
query("comparison_table", _REPORT)(
    lambda v: cm.comparison_table(demo(v), "patient_num", "pos_confirmed", NUMERIC, CATEGORICAL, GROUPS, with_p=False)
)


query(
    "numeric_profile_report",
    f"""SELECT n.var, grp, round(p_value, 6) AS p_value,
               cast(n AS varchar) || '; ' || {_text("val_mean", 2)} || '(' || {_text("val_sd", 3)} || '); '
               || {_text("val_med", 6)} || '(' || {_text("val_q1", 6)} || ',' || {_text("val_q3", 6)} || ')' AS label
        FROM $w_num n LEFT JOIN (FROM ({_ANOVA_P})) p ON p.var = n.var""",
)(
    lambda v: r6(
        cm.numeric_profile(demo(v), "patient_num", "pos_confirmed", NUMERIC, with_p=True).select(
            "var", "grp", "p_value", "label"
        )
    )
)
@query(
    "categorical_profile_report",
    f"""SELECT var, grp, val, cast(n AS varchar) || '; (' || {_text("(prop * 100)", 2)} || '%)' AS label,
               s.fits AS p_fits
        FROM $w_cat LEFT JOIN (SELECT var, CASE WHEN least >= 5 THEN true END AS fits FROM ({_CHISQ}) WHERE df > 0 AND df % 2 = 0) s
          USING (var)""",
)
def _(v):
    """The profile's simulated p against the limit's tail, as :func:`simulated` does it."""
    profile = cm.categorical_profile(demo(v), "patient_num", "pos_confirmed", CATEGORICAL, with_p=True)
    tail = F.col("tail")
    near = F.abs(F.col("p_value") - tail) <= 4 * F.sqrt(tail * (1 - tail) / 2000) + 2.0 / 2000
    return profile.join(simulated(v).select("var", "tail", "agrees"), "var", "left").select(
        "var", "grp", "val", "label", F.when(F.col("agrees").isNotNull(), near).alias("p_fits")
    )


@query(
    "comparison_report",
    f"""SELECT r.*, p.p_value, s.agrees FROM ({_REPORT}) r
        LEFT JOIN (SELECT var, round_even(p_value, 4) AS p_value FROM ({_ANOVA_P})) p ON p.var = r.var
        LEFT JOIN (SELECT var, CASE WHEN least >= 5 THEN true END AS agrees FROM ({_CHISQ}) WHERE df > 0) s ON s.var = r.var""",
)
def _(v):
    """The report; the simulated p of a category is checked against its limit, as it has no closed form."""
    stay = v("fx_stay")
    report = cl.cohort_report(stay.where("pos_confirmed > 0"), stay.where("pos_confirmed = 0"))
    p = F.col("`p.value`")
    tail, found = F.col("tail"), simulated(v)
    near = F.abs(p - tail) <= 4 * F.sqrt(tail * (1 - tail) / 2000) + 2.0 / 2000
    return report.join(found, "var", "left").select(
        "var", "cat", *GROUPS, F.when(F.col("df").isNull(), p).alias("p_value"), F.when(F.col("agrees").isNotNull(), near).alias("agrees")
    )


query(
    "sparse_coo",
    """SELECT i, j, cast(count(*) AS double) AS x, e.patient_num, e.concept_cd
       FROM $fx_obs e
       JOIN (SELECT patient_num, row_number() OVER (ORDER BY patient_num) AS i
             FROM (SELECT DISTINCT patient_num FROM $fx_obs)) a ON a.patient_num = e.patient_num
       JOIN (SELECT concept_cd, row_number() OVER (ORDER BY concept_cd) AS j
             FROM (SELECT DISTINCT concept_cd FROM $fx_obs)) b ON b.concept_cd = e.concept_cd
       GROUP BY ALL""",
)(lambda v: rs.sparse_coo(v("fx_obs"), "patient_num", "concept_cd", binary=True))
query(
    "sparse_values",
    """SELECT i, j, round(sum(coalesce(nval_num, 1)), 4) AS x, e.patient_num, e.concept_cd
       FROM $fx_obs e
       JOIN (SELECT patient_num, row_number() OVER (ORDER BY patient_num) AS i
             FROM (SELECT DISTINCT patient_num FROM $fx_obs)) a ON a.patient_num = e.patient_num
       JOIN (SELECT concept_cd, row_number() OVER (ORDER BY concept_cd) AS j
             FROM (SELECT DISTINCT concept_cd FROM $fx_obs)) b ON b.concept_cd = e.concept_cd
       GROUP BY ALL""",
)(lambda v: r6(rs.sparse_coo(v("fx_obs"), "patient_num", "concept_cd", "nval_num"), 4))


query(
    "sparse_binary",
    """SELECT DISTINCT dense_rank() OVER (ORDER BY patient_num) AS i, dense_rank() OVER (ORDER BY concept_cd) AS j,
              cast(1 AS double) AS x, patient_num, concept_cd FROM $fx_obs
       WHERE patient_num IS NOT NULL AND concept_cd IS NOT NULL""",
)(lambda v: rs.sparse_coo(v("fx_obs"), "patient_num", "concept_cd", binary=True, sum_duplicates=False))
query(
    "sparse_row_lists",
    """SELECT i, string_agg(cast(j AS varchar), ' ' ORDER BY j) AS indices,
              string_agg(cast(cast(n AS bigint) AS varchar), ' ' ORDER BY j) AS x
       FROM (SELECT i, j, count(*) AS n
             FROM (SELECT dense_rank() OVER (ORDER BY patient_num) AS i, dense_rank() OVER (ORDER BY concept_cd) AS j
                   FROM $fx_obs WHERE patient_num IS NOT NULL AND concept_cd IS NOT NULL)
             GROUP BY ALL)
       GROUP BY i""",
)(
    lambda v: rs.sparse_rows(rs.sparse_coo(v("fx_obs"), "patient_num", "concept_cd", binary=True)).select(
        "i",
        F.array_join("indices", " ").alias("indices"),
        F.array_join(F.transform("values", lambda x: x.cast("long")), " ").alias("x"),
    )
)

# --------------------------------------------------------------- evaluation

_ROUNDED_SWEEP = ", ".join(
    f"round({c}, 6) AS {c}"
    for c in (
        "cutoff prec rec_sens ppv npv prec_rec_dist fscore spec euclid_meas youden_meas pcfall acc mcc"
    ).split()
)


def counts(v: Views, view: str = "fx_pred") -> DataFrame:
    return ev.score_counts(v(view))


def _roc_sql(kind: str) -> str:
    return f"""SELECT greatest(auc - 1.959963984540054 * se, 0) AS roauc_low, auc AS roauc,
               least(auc + 1.959963984540054 * se, 1) AS roauc_up
        FROM (SELECT CASE WHEN mc > mp THEN 1 - auc ELSE auc END AS auc, sqrt(s10 / np + s01 / nn) AS se
              FROM (SELECT sum(v10) FILTER (real = 1) / count(*) FILTER (real = 1) AS auc,
                           var_samp(v10) FILTER (real = 1) AS s10, var_samp(v01) FILTER (real = 0) AS s01,
                           count(*) FILTER (real = 1) AS np, count(*) FILTER (real = 0) AS nn,
                           quantile_cont(pred, 0.5) FILTER (real = 1) AS mp,
                           quantile_cont(pred, 0.5) FILTER (real = 0) AS mc
                    FROM (SELECT x.pred, x.real,
                                 ((n_total - p_total) - (n_cum - p_cum) + (n - p) / 2) / (n_total - p_total) AS v10,
                                 (p_cum - p + p / 2) / p_total AS v01
                          FROM $fx_{kind if kind == 'pred' else kind + '_pred'} x
                          JOIN $w_{kind}_counts c ON x.pred = c.score)))"""


def _pr_sql(kind: str) -> str:
    return f"""SELECT sum(smooth) / any_value(pos) AS prauc1, sum(stepped) / any_value(pos) AS prauc2
        FROM (SELECT pos,
                     CASE WHEN abs(b) < 1e-9 THEN p / a
                          ELSE p / a - b / (a * a) * ln((a * x1 + b) / (a * x0 + b)) END AS smooth,
                     CASE WHEN abs(b) < 1e-9 THEN p / a ELSE list_sum(list_transform(
                       range(0, cast(p AS bigint)),
                       lambda i: ((x0 + i) / (a * (x0 + i) + b) + (x0 + i + 1) / (a * (x0 + i + 1) + b)) / 2))
                     END AS stepped
              FROM (SELECT *, 1 + h AS a, f0 - h * x0 AS b
                    FROM (SELECT cast(p AS double) AS p, cast(p_total AS double) AS pos,
                                 cast(p_cum - p AS double) AS x0, cast(p_cum AS double) AS x1,
                                 cast(n_cum - p_cum - n + p AS double) AS f0,
                                 cast(n - p AS double) / p AS h
                          FROM $w_{kind}_counts WHERE p > 0)))"""


def _points_sql(kind: str) -> str:
    return f"""SELECT c.cutoff AS opt_thresh, c.rec_sens AS opt_sens, c.spec AS opt_spec, c.ppv AS opt_ppv,
               c.npv AS opt_npv, b.prec AS opt_prec, b.rec_sens AS opt_rec, b.fscore AS opt_fscore
        FROM (SELECT * FROM $w_{kind}_sweep ORDER BY euclid_meas, cutoff LIMIT 1) c,
             (SELECT * FROM $w_{kind}_sweep ORDER BY prec_rec_dist, cutoff LIMIT 1) b"""


def _means_sql(kind: str) -> str:
    return "SELECT " + ", ".join(f"avg({c}) AS {n}" for c, n in ev.MEANS.items()) + f" FROM $w_{kind}_sweep"


def _rounded_sql(text: str) -> str:
    return f"SELECT round(COLUMNS(*), 6) FROM ({text})"


query("threshold_sweep", f"SELECT {_ROUNDED_SWEEP}, size FROM $w_pred_sweep")(
    lambda v: r6(ev.threshold_sweep(counts(v)))
)
query("roc_auc_ci", _rounded_sql(_roc_sql("pred")))(lambda v: r6(ev.roc_auc_ci(counts(v))))
query("pr_auc", _rounded_sql(_pr_sql("pred")))(lambda v: r6(ev.pr_auc(counts(v))))
query("operating_point", _rounded_sql(_points_sql("pred")))(
    lambda v: r6(ev.operating_point(ev.threshold_sweep(counts(v))))
)
query("cutoff_means", _rounded_sql(_means_sql("pred")))(
    lambda v: r6(ev.cutoff_means(ev.threshold_sweep(counts(v))))
)

def _summary_sql(kind: str, digits: int) -> str:
    parts = " UNION ALL ".join(
        f"FROM (UNPIVOT ({part(kind)}) ON COLUMNS(*) INTO NAME overall_meas VALUE meas_val)"
        for part in (_roc_sql, _points_sql, _pr_sql, _means_sql)
    )
    return f"SELECT overall_meas, round(meas_val, {digits}) AS meas_val FROM ({parts})"


query("perf_summary", _summary_sql("label", 6))(lambda v: r6(ev.perf_summary(v("fx_label_pred"))))


def _calibration_sql(view: str) -> str:
    points = ", ".join(f"{i} / 20" for i in range(21))
    return f"""SELECT pred_bin, expos, round(bin_lower, 6) AS bin_lower, round(bin_upper, 6) AS bin_upper,
               round(bin_mid, 6) AS bin_mid, y_agg, round(pred_p, 6) AS pred_p,
               round(y_agg / expos, 6) AS y_p,
               round(greatest(0, pred_p - 1.96 * sqrt(y_agg / expos * (1 - y_agg / expos) / expos)), 6) AS binci_lower,
               round(pred_p + 1.96 * sqrt(y_agg / expos * (1 - y_agg / expos) / expos), 6) AS binci_upper
        FROM (SELECT cast(greatest(len(list_filter(q, lambda e: e < pred)), 1) AS int) AS pred_bin,
                     count(*) AS expos, min(pred) AS bin_lower, max(pred) AS bin_upper,
                     quantile_cont(pred, 0.5) AS bin_mid, cast(sum(real) AS bigint) AS y_agg,
                     avg(pred) AS pred_p
              FROM $fx_{view}, (SELECT list_distinct(quantile_cont(pred, [{points}])) AS q FROM $fx_{view})
              GROUP BY 1)"""


query("calibration", _calibration_sql("pred"))(lambda v: r6(ev.calibration(v("fx_pred"))))
query("calibration_ties", _calibration_sql("label_pred"))(
    lambda v: r6(ev.calibration(v("fx_label_pred")))
)


# -------------------------------------------------------------------- shape

_SHAPED = ["age_at_admit", "sex_female", "hosdead"]
_LONG = " UNION ALL ".join(
    f"SELECT encounter_num, '{c}' AS var, cast({c} AS bigint) AS val FROM $fx_stay" for c in _SHAPED
)
query("gather", _LONG)(lambda v: rs.gather(v("fx_stay"), ["encounter_num"], _SHAPED, "long"))
query(
    "gather_spread",
    "SELECT patient_num, "
    + ", ".join(f"max(val) FILTER (var = '{c}') AS {c}" for c in _SHAPED)
    + f" FROM (SELECT encounter_num // 10 AS patient_num, var, val FROM ({_LONG})) GROUP BY patient_num",
)(
    lambda v: rs.spread(
        rs.gather(v("fx_stay"), ["patient_num"], _SHAPED, "long"), ["patient_num"], "var", "val", _SHAPED
    )
)
query(
    "unite_separate",
    """SELECT concept_cd || '=' || coalesce(tval_char, 'NA') AS united, concept_cd AS var,
              coalesce(tval_char, 'NA') AS cat, count(*) AS n FROM $fx_fact GROUP BY ALL""",
)(
    lambda v: v("fx_fact")
    .select(rs.unite(["concept_cd", "tval_char"], "=").alias("united"))
    .groupBy("united")
    .agg(F.count("*").alias("n"))
    .select("united", *rs.separate(F.col("united"), ("var", "cat")), "n")
)
query(
    "events_stacked",
    """SELECT patid, encounterid, result_date, px_date, lab_px, px FROM (
         SELECT patid, encounterid, result_date, lab_px FROM $fx_lab
         UNION ALL BY NAME SELECT patid, encounterid, px_date, px FROM $fx_px)""",
)(
    lambda v: stack(
        [
            v("fx_lab").select("patid", "encounterid", "result_date", "lab_px"),
            v("fx_px").select("patid", "encounterid", "px_date", "px"),
        ]
    )
)
query(
    "respiratory_groups",
    """SELECT icd_key, dx_ccs_grp1, dx_ccs_grp2, count(*) AS n, count(DISTINCT patid) AS n_patients
       FROM $fx_dx JOIN (SELECT DISTINCT * FROM $w_prefixes) ON dx LIKE icd_key || '%' GROUP BY ALL""",
)(
    lambda v: co.prefix_matches(v("fx_dx").select("patid", "dx"), "dx", refdata.respiratory_prefixes(v.spark))
    .groupBy("icd_key", "dx_ccs_grp1", "dx_ccs_grp2")
    .agg(F.count("*").alias("n"), F.count_distinct("patid").alias("n_patients"))
)


# ------------------------------------------------------------------- models

_COEFFICIENTS = """SELECT term, round(estimate, 4) AS estimate, round(std_error, 4) AS std_error,
    round(statistic, 4) AS statistic, round(p_value, 4) AS p_value FROM $w_glm_"""


@query("glm_logistic", _COEFFICIENTS + "logistic")
def _(v):
    fit = fit_glm(initial(v), "hosdead", ["pos_confirmed", "age_at_admit", "sofa_init"])
    return r6(fit.coefficients, 4)


@query("glm_logistic_factor", _COEFFICIENTS + "factor")
def _(v):
    fit = fit_glm(
        initial(v), "hosdead", ["pos_confirmed", "sofa_init"], categorical=["pos_confirmed"]
    )
    return r6(fit.coefficients, 4)


@query("glm_poisson", _COEFFICIENTS + "poisson")
def _(v):
    rows = cl.counted_hours(initial(v), drop_negative=True)
    fit = fit_glm(rows, "mv_dur_hour", ["pos_confirmed", "age_at_admit", "sofa_init"], "poisson")
    return r6(fit.coefficients, 4)


@query("glm_performance", _summary_sql("fit", 4))
def _(v):
    rows = checkpointed(initial(v))
    fit = fit_glm(rows, "hosdead", ["pos_confirmed", "sofa_init"])
    return r6(ev.perf_summary(fitted(fit, rows, "hosdead")), 4)


for _name, _only in (("positive", 2), ("negative", 0)):
    query(f"glm_score_{_name}", _COEFFICIENTS + _name)(
        lambda v, only=_only: r6(
            fit_glm(initial(v).where(F.col("pos_confirmed") == only), "hosdead", ["sofa_init"]).coefficients, 4
        )
    )


def long_exposure(v: Views) -> DataFrame:
    return initial(v).withColumn("mv_long", (F.col("mv_dur_hour") >= 96).cast("int"))


query("glm_long_exposure", _COEFFICIENTS + "long")(
    lambda v: r6(fit_glm(long_exposure(v), "mv_long", ["pos_confirmed", "sofa_init"]).coefficients, 4)
)


@query("glm_poisson_performance", _summary_sql("hours", 4))
def _(v):
    rows = checkpointed(cl.counted_hours(initial(v), drop_negative=True))
    fit = fit_glm(rows, "mv_dur_hour", ["pos_confirmed", "age_at_admit", "sofa_init"], "poisson")
    return r6(ev.perf_summary(fitted(fit, rows, "mv_dur_hour", "mv_dur_hour >= 96")), 4)


# the closed form of a logistic model with one 0/1 predictor
query(
    "glm_binary_closed",
    """SELECT term, round(estimate, 4) AS estimate, round(std_error, 4) AS std_error
       FROM (SELECT ln(a * d / (b * c)) AS slope, sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS slope_se,
                    ln(c / d) AS base, sqrt(1 / c + 1 / d) AS base_se
             FROM (SELECT cast(count(*) FILTER (x = 1 AND y = 1) AS double) AS a,
                          cast(count(*) FILTER (x = 1 AND y = 0) AS double) AS b,
                          cast(count(*) FILTER (x = 0 AND y = 1) AS double) AS c,
                          cast(count(*) FILTER (x = 0 AND y = 0) AS double) AS d
                   FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS x,
                                CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS y FROM $lineitem))),
            LATERAL (SELECT 'x' AS term, slope AS estimate, slope_se AS std_error
                     UNION ALL SELECT '(Intercept)', base, base_se)""",
)(
    lambda v: r6(
        fit_glm(
            v("lineitem").select(
                (F.col("l_returnflag") == "A").cast("int").alias("x"),
                (F.col("l_linestatus") == "F").cast("int").alias("y"),
            ),
            "y",
            ["x"],
        ).coefficients.select("term", "estimate", "std_error"),
        4,
    )
)


# -------------------------------------------------------- sites and look-ups

_INSIDE = "site_lon BETWEEN -124.7 AND -67.0 AND site_lat BETWEEN 25.1 AND 49.4"
_SHOWN = "CASE WHEN pos < 11 THEN '< 11' ELSE cast(pos AS varchar) END"
query(
    "site_feed",
    f"""SELECT DISTINCT state, site_lon, site_lat, site_short, test, pos, {_SHOWN} AS pos_shown,
               site_short || ':' || cast(test AS varchar) || '(' || {_SHOWN} || ')' AS label
        FROM $fx_site WHERE {_INSIDE} AND test IS NOT NULL""",
)(lambda v: si.site_feed(v("fx_site"), US_LONS, US_LATS))
query(
    "sites_outside",
    f"SELECT state, site_lon, site_lat, site_short, test FROM $fx_site WHERE NOT ({_INSIDE})",
)(
    lambda v: si.outside(v("fx_site"), US_LONS, US_LATS).select(
        "state", "site_lon", "site_lat", "site_short", "test"
    )
)
query(
    "state_layer",
    """SELECT lower(n_name) AS region, n_regionkey, s.state_pos
       FROM $nation LEFT JOIN (SELECT DISTINCT state, state_pos FROM $fx_site) s
         ON lower(n_name) = s.state""",
)(
    lambda v: si.state_layer(
        v("nation").select(F.lower("n_name").alias("region"), "n_regionkey"), v("fx_site")
    ).select("region", "n_regionkey", "state_pos")
)
query(
    "small_cell_label",
    """SELECT concept_cd, CASE WHEN n < 11 THEN '< 11' ELSE cast(n AS varchar) END AS shown
       FROM (SELECT concept_cd, count(DISTINCT patient_num) AS n FROM $fx_fact
             GROUP BY concept_cd)""",
)(
    lambda v: v("fx_fact")
    .groupBy("concept_cd")
    .agg(F.count_distinct("patient_num").alias("n"))
    .select("concept_cd", sc.suppressed(F.col("n")).alias("shown"))
)
query(
    "code_url",
    """SELECT p_partkey, 'https://loinc.org/' || cast(p_partkey AS varchar) || '-' || cast(p_size % 10 AS varchar) AS url
       FROM $part""",
)(
    lambda v: v("part").select(
        "p_partkey",
        sc.loinc_url(
            F.concat(F.col("p_partkey").cast("string"), F.lit("-"), (F.col("p_size") % 10).cast("string"))
        ).alias("url"),
    )
)
query(
    "code_split",
    """SELECT code, CASE WHEN split_part(code, ':', 1) = 'CH' THEN 'CPT' ELSE split_part(code, ':', 1) END AS system,
              regexp_replace(code, '.*:', '') AS bare,
              'https://www.google.com/search?q=' || CASE WHEN split_part(code, ':', 1) = 'CH' THEN 'CPT'
                ELSE split_part(code, ':', 1) END || ':' || regexp_replace(code, '.*:', '') AS url
       FROM (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'CH' ELSE 'ICD10' END || ':'
                    || cast(l_partkey AS varchar) AS code FROM $lineitem)""",
)(
    lambda v: v("lineitem")
    .select(
        F.concat(
            F.when(F.col("l_linenumber") % 2 == 0, "CH").otherwise("ICD10"),
            F.lit(":"),
            F.col("l_partkey").cast("string"),
        ).alias("code")
    )
    .select(
        "code",
        sc.code_system(F.col("code")).alias("system"),
        sc.after_last_colon(F.col("code")).alias("bare"),
        sc.search_url(F.col("code")).alias("url"),
    )
)
query(
    "code_name_lookup",
    """SELECT l_orderkey, l_linenumber, l_suppkey AS code, CASE WHEN k > 1
              THEN 'https://ndclist.com/?s=' || cast(l_suppkey AS varchar) ELSE nm END AS name
       FROM $lineitem LEFT JOIN (SELECT p_partkey - CASE WHEN p_partkey % 3 = 2 THEN 1 ELSE 0 END AS code,
                                        count(p_name) AS k, min(p_name) AS nm FROM $part GROUP BY ALL) d
         ON l_suppkey = d.code""",
)(
    lambda v: lo.code_names(
        v("lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("code")),
        v("part").selectExpr(
            "p_partkey - CASE WHEN p_partkey % 3 = 2 THEN 1 ELSE 0 END AS code", "p_name AS name"
        ),
        F.concat(F.lit("https://ndclist.com/?s="), F.col("code").cast("string")),
    )
)
query(
    "first_secure_link",
    r"""SELECT page_id, regexp_replace(regexp_replace(first, '&sa=U.*$', '', 's'), '^.*https://', 'https://', 's')
                AS link
       FROM (SELECT page_id, list_filter(flatten(list_transform(
               regexp_extract_all(html, '(?is)<h3\b[^>]*>(.*?)</h3>', 1),
               lambda h: regexp_extract_all(h, '(?is)<a\b[^>]*?href="([^"]*)"', 1))),
               lambda u: contains(u, 'https:'))[1] AS first
             FROM $fx_page)""",
)(lambda v: v("fx_page").select("page_id", sc.first_secure_link(F.col("html")).alias("link")))
query(
    "first_secure_link_forms",
    r"""SELECT page_id, regexp_replace(regexp_replace(first, '&sa=U.*$', '', 's'), '^.*https://', 'https://', 's')
                AS link
       FROM (SELECT page_id, list_filter(list_transform(flatten(list_transform(
               regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(?is)<h3\b[^>]*>(.*?)</h3>', 1),
               lambda h: regexp_extract_all(h, '(?is)<a\s[^>]*?\bhref\s*=\s*("[^"]*"|''[^'']*''|[^\s>]+)', 1))),
               lambda u: replace(replace(trim(u, '"'''), '&#38;', '&'), '&amp;', '&')),
               lambda u: contains(u, 'https:'))[1] AS first
             FROM $fx_page_forms)""",
)(lambda v: v("fx_page_forms").select("page_id", sc.first_secure_link(F.col("html")).alias("link")))
