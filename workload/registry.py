"""Where queries and their oracle SQL are registered side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.session import tune
from cohortspark.sources import refdata
from workload.adapters import SPAN, YEARS, Views, duckdb_sql
from workload.newton import glm_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: the oracles as they were written, with ``$view`` names
ORACLE_TEXTS: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(views)`` as query ``name``; ``oracle`` is a text with ``$view`` names."""

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Views(tune(spark), folder))

        QUERIES[name] = run
        if oracle is not None:
            ORACLE_TEXTS[name] = oracle
            ORACLES[name] = duckdb_sql(oracle, ORACLE_VIEWS)
        return fn

    return register


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, for the comparison of two engines."""
    return df.select(
        *(
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        )
    )


def _values(rows: list[tuple], names: str) -> str:
    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, str):
            return "'" + value.replace("'", "''") + "'"
        return f"cast({value} AS double)" if isinstance(value, float) else str(value)

    body = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


STEPS = [
    (2, 1, [r"%ECONOMY\Brand_2\%"]),
    (2, 0, [r"%SMALL\Brand_7\%"]),
    (0, 1, [r"%PROMO\Brand_2_\%"]),
    (1, 1, [r"%LARGE\Brand_1_\%"]),
]


def _step_view(i: int) -> str:
    status, lab, (pattern,) = STEPS[i]
    earlier = "".join(
        f" AND patient_num NOT IN (SELECT patient_num FROM $w_step{j})" for j in range(i)
    )
    return f"""
        SELECT patient_num, encounter_num, {status} AS pos_confirmed, {lab} AS lab_int
        FROM $fx_fact JOIN (SELECT DISTINCT concept_cd FROM $fx_concept
                            WHERE concept_path LIKE '{pattern}') c USING (concept_cd)
        WHERE start_date >= TIMESTAMP '1998-01-01'{earlier}"""


def _hours(a: str, b: str, digits: int = 0) -> str:
    return f"round_even(cast(date_diff('microsecond', {a}, {b}) AS double) / 3.6e9, {digits})"


# the parts that several oracles share
ORACLE_VIEWS = {
    **{f"w_step{i}": _step_view(i) for i in range(4)},
    "w_facts_status": " UNION ALL ".join(f"SELECT * FROM $w_step{i}" for i in range(4)),
    "w_status": "SELECT DISTINCT * FROM $w_facts_status",
    "w_eligible": """
        SELECT e.*, coalesce(s.pos_confirmed, -1) AS covid_status
        FROM $fx_enc e
        LEFT JOIN (SELECT DISTINCT patient_num, encounter_num, pos_confirmed FROM $w_status) s
          ON e.patid = s.patient_num AND e.encounterid = s.encounter_num
        WHERE (s.pos_confirmed IS NOT NULL OR EXISTS (
                 SELECT 1 FROM $fx_dx d JOIN $fx_keys k
                   ON d.dx_type = '10' AND d.dx LIKE k.icd_key || '%'
                  AND d.admit_date >= DATE '1998-01-01'
                 WHERE d.patid = e.patid AND d.encounterid = e.encounterid))
          AND e.admit_date >= DATE '1998-01-01' AND e.enc_type IN ('ED', 'EI', 'IP')""",
    "w_bands": _values(
        refdata.SEVERITY_BANDS, "organ, code, lb, ub, direction, score, scale_type"
    ),
    "w_prefixes": _values(refdata.RESPIRATORY_PREFIXES, "icd_key, dx_ccs_grp1, dx_ccs_grp2"),
    "w_local_codes": _values(
        [(k, *row) for k, row in enumerate(refdata.OBSERVATION_CODES)],
        "k, raw_obsclin_name, obsclin_code, obsclin_type, i2b2_code, i2b2_label",
    ),
    "w_ranges": _values(
        refdata.WHITE_CELL_RANGES,
        "wbc_type, lab_name, component_id, normal_low, normal_high, normal_lowp, normal_highp",
    ),
    **{
        view: text
        for suffix, (first, last) in {"": SPAN, "_years": YEARS}.items()
        for view, text in {
            f"w_days{suffix}": f"""
        SELECT cast(unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS date)
                 AS date""",
            f"w_calendar_wide{suffix}": f"""
        SELECT date, dense_rank() OVER (ORDER BY date) AS date_daily,
               dense_rank() OVER (ORDER BY isoyear(date), week(date)) AS date_week, month(date) AS date_month
        FROM $w_days{suffix}""",
            f"w_calendar{suffix}": f"""
        SELECT date, 'date_daily' AS date_scale, date_daily AS date_rk FROM $w_calendar_wide{suffix}
        UNION ALL SELECT date, 'date_week', date_week FROM $w_calendar_wide{suffix}
        UNION ALL SELECT date, 'date_biweek', date_week // 2 + 1 FROM $w_calendar_wide{suffix}
        UNION ALL SELECT date, 'date_month', date_month FROM $w_calendar_wide{suffix}""",
        }.items()
    },
    "w_coded": "SELECT o.*, m.code FROM $fx_obs o JOIN $fx_code_map m ON o.concept_cd = m.i2b2_code",
    "w_mv_rows": """
        SELECT c.patient_num, c.encounter_num, c.code, c.start_date, s.icu_stay_end_dttm
        FROM $w_coded c JOIN $fx_stay s USING (patient_num, encounter_num)
        WHERE code IN ('Vent_init', 'Vent_mode')
          AND NOT (code = 'Vent_mode' AND coalesce(lower(tval_char), '') LIKE '%spont%')
          AND ((start_date <= icu_stay_end_dttm AND start_date >= icu_stay_start_dttm)
               OR icu_stay_start_dttm IS NULL)""",
    "w_mv": f"""
        SELECT DISTINCT patient_num, coalesce(i, m) AS mv_init, {_hours("coalesce(i, m)", "coalesce(x, icu_end)", 2)}
                 AS mv_dur_hour
        FROM (SELECT patient_num, encounter_num, icu_stay_end_dttm AS icu_end,
                     min(start_date) FILTER (code = 'Vent_init') AS i,
                     min(start_date) FILTER (code = 'Vent_mode') AS m,
                     max(start_date) FILTER (code = 'Vent_mode') AS x
              FROM $w_mv_rows GROUP BY ALL)
        WHERE coalesce(x, icu_end) IS NOT NULL AND coalesce(i, m) IS NOT NULL""",
    "w_band_edges": """
        SELECT DISTINCT code, edge FROM (SELECT code, unnest([lb, ub]) AS edge FROM $w_bands) WHERE edge IS NOT NULL""",
    "w_banded": """
        SELECT c.patient_num, c.encounter_num, c.code, c.start_date, c.nval_num, b.organ,
               b.score AS pat_score
        FROM $w_coded c JOIN $w_bands b ON c.code = b.code
        WHERE CASE WHEN direction = 'l' THEN nval_num < ub WHEN direction = 'le' THEN nval_num <= ub
                   WHEN direction = 'g' THEN nval_num > lb
                   WHEN scale_type = 'c' THEN nval_num >= lb AND nval_num < ub
                   ELSE nval_num >= lb AND nval_num <= ub END""",
    # equal pressures at one moment are one row before banding
    "w_banded_once": """
        SELECT patient_num, encounter_num, code, start_date, nval_num, organ, pat_score
        FROM $w_banded WHERE code <> 'MAP'
        UNION ALL
        SELECT patient_num, encounter_num, 'MAP', start_date, m, 'CARDIO',
               CASE WHEN m > 70 THEN 0 ELSE 1 END
        FROM (SELECT patient_num, encounter_num, start_date, max(nval_num) AS m
              FROM $w_coded WHERE code = 'MAP' GROUP BY ALL) WHERE m <> 70""",
    "w_scored": f"""
        SELECT b.*, s.pos_confirmed, s.hosdead, s.age_at_admit, s.sex_female, s.hosp_admsn_dttm,
               s.icu_stay_start_dttm, s.icu_length_of_stay_days, v.mv_init, v.mv_dur_hour,
               {_hours("s.hosp_admsn_dttm", "b.start_date")} AS hr_since_admin,
               least(greatest({_hours("s.icu_stay_start_dttm", "b.start_date")}, 0),
                     round_even(s.icu_length_of_stay_days * 24, 0)) AS hr_since_icu,
               least(greatest({_hours("v.mv_init", "b.start_date")}, 0), round_even(v.mv_dur_hour, 0))
                 AS hr_since_mv
        FROM $w_banded_once b JOIN $fx_stay s ON b.patient_num = s.patient_num
        LEFT JOIN $w_mv v ON b.patient_num = v.patient_num
        WHERE b.start_date >= s.hosp_admsn_dttm - INTERVAL 72 HOUR
          AND (v.mv_init IS NULL OR v.mv_init >= b.start_date - INTERVAL 24 HOUR)""",
    "w_initial": """
        SELECT patient_num, encounter_num, pos_confirmed, hosdead, age_at_admit, sex_female,
               mv_dur_hour, cast(sum(pat_score) AS bigint) AS sofa_init,
               max(hr_since_admin) AS sofa_init_since_admin, max(hr_since_icu) AS sofa_init_since_icu
        FROM (SELECT *, row_number() OVER (
                PARTITION BY patient_num, encounter_num, organ
                ORDER BY start_date, pat_score DESC, hosp_admsn_dttm, mv_dur_hour NULLS LAST,
                  hr_since_admin NULLS LAST, hr_since_icu NULLS LAST, hr_since_mv NULLS LAST) AS rn
              FROM $w_scored) WHERE rn = 1 GROUP BY ALL""",
    "w_lab": """
        SELECT DISTINCT f.patient_num, f.encounter_num, r.wbc_type, r.component_id, f.nval_num,
               upper(f.units_cd) AS units, f.start_date, f.start_since_lab
        FROM $fx_wbc f JOIN $w_ranges r ON r.component_id = regexp_replace(f.concept_cd, '.*:', '')
        WHERE f.tval_char = 'E' AND upper(f.units_cd) = 'K/UL'""",
    "w_lab_perc": """
        SELECT DISTINCT p.patient_num, p.encounter_num, p.wbc_type, p.component_id,
               CASE WHEN p.nval_num > t.nval_num THEN round_even(p.nval_num / nullif(t.nval_num, 0), 3) / 10
                    ELSE round_even(p.nval_num / nullif(t.nval_num, 0), 3) * 100 END AS nval_num,
               '%' AS units, p.start_date, p.start_since_lab
        FROM $w_lab p JOIN $w_lab t USING (patient_num, encounter_num, start_since_lab)
        WHERE p.wbc_type <> 'WBC' AND t.wbc_type = 'WBC'""",
    **{
        f"w_lab_{short}": f"""
        SELECT DISTINCT p.patient_num, p.encounter_num, p.wbc_type || '-to-{name}' AS wbc_type,
               p.component_id,
               CASE WHEN t.nval_num > 0 THEN round_even(p.nval_num / t.nval_num, 3) ELSE 0 END AS nval_num,
               'ratio' AS units, p.start_date, p.start_since_lab
        FROM $w_lab p JOIN $w_lab t USING (patient_num, encounter_num, start_since_lab)
        WHERE p.wbc_type NOT IN ('WBC', '{base}') AND t.wbc_type = '{base}'"""
        for short, name, base in (("lymph", "Lymph", "Lymphocyte"), ("neut", "Neut", "Neutrophils"))
    },
    "w_lab_all": """
        SELECT l.*, CASE WHEN nval_num < normal_low THEN 'low' WHEN nval_num > normal_high THEN 'high'
                         ELSE 'normal' END AS nval_fac
        FROM $w_lab l JOIN $w_ranges r ON l.component_id = r.component_id
        UNION ALL BY NAME
        SELECT l.*, CASE WHEN nval_num < normal_lowp THEN 'low' WHEN nval_num > normal_highp THEN 'high'
                         ELSE 'normal' END AS nval_fac
        FROM $w_lab_perc l JOIN $w_ranges r ON l.component_id = r.component_id
        UNION ALL BY NAME SELECT * FROM $w_lab_lymph
        UNION ALL BY NAME SELECT * FROM $w_lab_neut""",
    "w_lab_first": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (
            PARTITION BY patient_num, encounter_num, wbc_type, component_id, units
            ORDER BY start_since_lab DESC NULLS LAST, start_date, nval_num NULLS LAST) AS rn
          FROM $w_lab_all) WHERE rn = 1""",
    "w_features": """
        SELECT * REPLACE (CASE WHEN ed_episode = 1 AND adt_pat_class = 'Inpatient'
                               THEN 'Emergency-Inpatient' ELSE adt_pat_class END AS adt_pat_class),
               round_even(cast(date_diff('microsecond', hosp_admsn_dttm, hosp_disch_dttm) AS double)
                          / 8.64e10, 0) AS hosp_los,
               CASE WHEN icu_stay_start_dttm IS NULL THEN 0 ELSE 1 END AS icu_ind
        FROM $fx_stay""",
    "w_longest": """
        SELECT patient_num, encounter_num, greatest(hosp_los, 1) AS hosp_los, hosp_admsn_dttm
        FROM $w_features
        WHERE adt_pat_class <> 'Emergency' AND pos_confirmed = 2 AND hosp_los IS NOT NULL""",
    "w_demo": """
        SELECT patient_num, encounter_num,
               CASE pos_confirmed WHEN 2 THEN 'POS' WHEN 0 THEN 'NEG' WHEN 1 THEN 'PEND' END AS pos_confirmed,
               disch_disp, admsn_dx_group, sex_female, age_at_admit, icu_length_of_stay_days,
               CASE WHEN icu_length_of_stay_days IS NULL THEN 0 ELSE 1 END AS icu_ind,
               CASE WHEN regexp_matches(lower(disch_disp), 'nursing|hospice|rehap|long term care|home health')
                      THEN 'SNF-HOSP-REHAP-LTC-HHA'
                    WHEN lower(disch_disp) LIKE '%home or self%' THEN 'HOME'
                    WHEN lower(disch_disp) LIKE '%expired%' THEN 'DEATH' ELSE 'OT' END AS disch_disp_grp,
               CASE WHEN admsn_dx_group IN ('GENERAL SYMPTOMS AND SIGNS', 'OTHER BACTERIAL DISEASES',
                      'SYMPTOMS AND SIGNS INVOLVING THE CIRCULATORY AND RESPIRATORY SYSTEMS',
                      'SYMPTOMS AND SIGNS INVOLVING THE DIGESTIVE SYSTEM AND ABDOMEN',
                      'INFLUENZA AND PNEUMONIA') THEN admsn_dx_group
                    WHEN admsn_dx_group LIKE '%PERSONS WITH POTENTIAL HEALTH HAZARDS%'
                      THEN 'PERSONS WITH POTENTIAL HEALTH HAZARDS'
                    WHEN admsn_dx_group IS NULL THEN NULL ELSE 'OT' END AS admsn_dx_grp
        FROM $fx_stay WHERE adt_pat_class LIKE '%Inpatient%'""",
    "w_demo_num": """
        SELECT pos_confirmed AS grp, patient_num AS id, 'age_at_admit' AS var, cast(age_at_admit AS double) AS val
        FROM $w_demo
        UNION ALL SELECT pos_confirmed, patient_num, 'icu_length_of_stay_days', icu_length_of_stay_days FROM $w_demo""",
    "w_demo_cat": " UNION ALL ".join(
        f"SELECT pos_confirmed AS grp, patient_num AS id, '{c}' AS var, cast({c} AS varchar) AS val FROM $w_demo"
        for c in ("sex_female", "icu_ind", "disch_disp_grp", "admsn_dx_grp")
    ),
    "w_cat": """
        SELECT c.var, c.grp, c.val, t.tot, m.val_miss, c.n, round_even(cast(c.n AS double) / t.tot, 4) AS prop
        FROM (SELECT var, grp, val, count(DISTINCT id) AS n FROM $w_demo_cat WHERE val IS NOT NULL GROUP BY ALL) c
        JOIN (SELECT pos_confirmed AS grp, count(DISTINCT patient_num) AS tot FROM $w_demo GROUP BY ALL) t
          ON c.grp = t.grp
        JOIN (SELECT var, count(*) FILTER (val IS NULL) AS val_miss FROM $w_demo_cat GROUP BY ALL) m
          ON c.var = m.var""",
    "w_cells": "SELECT var, val, grp, count(*) AS o FROM $w_demo_cat WHERE val IS NOT NULL GROUP BY ALL",
    "w_cell_rows": "SELECT var, val, sum(o) AS r FROM $w_cells GROUP BY ALL",
    "w_cell_cols": "SELECT var, grp, sum(o) AS c FROM $w_cells GROUP BY ALL",
    "w_num": """
        SELECT var, grp, (SELECT count(DISTINCT patient_num) FROM $w_demo d WHERE d.pos_confirmed = x.grp) AS n,
               count(*) FILTER (val IS NULL) AS val_miss, count(val) AS val_n, avg(val) AS val_mean,
               stddev_samp(val) AS val_sd, quantile_cont(val, 0.5) AS val_med,
               quantile_cont(val, 0.25) AS val_q1, quantile_cont(val, 0.75) AS val_q3,
               min(val) AS val_min, max(val) AS val_max
        FROM $w_demo_num x GROUP BY var, grp""",
    **{
        f"w_{kind}_counts": f"""
        SELECT score, n, p, sum(n) OVER w AS n_cum, sum(p) OVER w AS p_cum, sum(n) OVER () AS n_total,
               sum(p) OVER () AS p_total
        FROM (SELECT pred AS score, count(*) AS n, sum(real) AS p FROM $fx_{view} GROUP BY pred)
        WINDOW w AS (ORDER BY score DESC)"""
        for kind, view in (("pred", "pred"), ("label", "label_pred"), ("fit", "fit_pred"), ("hours", "hours_pred"))
    },
    **{
        f"w_{kind}_sweep": f"""
        SELECT score AS cutoff, tp / (tp + fp) AS prec, tp / (tp + fn) AS rec_sens, tp / (tp + fp) AS ppv,
               tn / (tn + fn) AS npv, abs(tp / (tp + fp) - tp / (tp + fn)) AS prec_rec_dist,
               2 * tp / (2 * tp + fp + fn) AS fscore, tn / (tn + fp) AS spec,
               sqrt(power(1 - tp / (tp + fn), 2) + power(1 - tn / (tn + fp), 2)) AS euclid_meas,
               tp / (tp + fn) + tn / (tn + fp) - 1 AS youden_meas, fp / (tp + fp) AS pcfall,
               (tp + tn) / (tp + tn + fp + fn) AS acc,
               (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) AS mcc,
               cast(1 AS bigint) AS size
        FROM (SELECT score, cast(p_cum AS double) AS tp, cast(n_cum - p_cum AS double) AS fp,
                     cast(p_total - p_cum AS double) AS fn,
                     cast(n_total - n_cum - p_total + p_cum AS double) AS tn FROM $w_{kind}_counts)
        WHERE tp > 0 AND tn > 0"""
        for kind in ("pred", "label", "fit", "hours")
    },
    **glm_views("glm_logistic", "$w_initial", "hosdead", {c: c for c in ("pos_confirmed", "age_at_admit", "sofa_init")}),
    **glm_views("glm_factor", "$w_initial", "hosdead", {
        "pos_confirmed_2": "pos_confirmed = 2", "pos_confirmed_1": "pos_confirmed = 1", "sofa_init": "sofa_init",
    }),
    **glm_views(
        "glm_poisson", "(FROM $w_initial WHERE mv_dur_hour >= 0)", "mv_dur_hour",
        {c: c for c in ("pos_confirmed", "age_at_admit", "sofa_init")}, "poisson",
    ),
    **glm_views("glm_positive", "(FROM $w_initial WHERE pos_confirmed = 2)", "hosdead", {"sofa_init": "sofa_init"}),
    **glm_views("glm_negative", "(FROM $w_initial WHERE pos_confirmed = 0)", "hosdead", {"sofa_init": "sofa_init"}),
    **glm_views(
        "glm_long", "(FROM $w_initial WHERE mv_dur_hour IS NOT NULL)", "cast(mv_dur_hour >= 96 AS int)",
        {c: c for c in ("pos_confirmed", "sofa_init")},
    ),
    "fx_hours_pred": """
        SELECT exp(b0 + b1 * pos_confirmed + b2 * age_at_admit + b3 * sofa_init) AS pred,
               cast(mv_dur_hour >= 96 AS int) AS real
        FROM $w_initial, $w_glm_poisson_b WHERE mv_dur_hour >= 0""",
    **glm_views("glm_status", "$w_initial", "hosdead", {c: c for c in ("pos_confirmed", "sofa_init")}),
    "fx_fit_pred": """
        SELECT 1 / (1 + exp(-(b0 + b1 * pos_confirmed + b2 * sofa_init))) AS pred, hosdead AS real
        FROM $w_initial, $w_glm_status_b WHERE hosdead IS NOT NULL AND pos_confirmed IS NOT NULL""",
}
