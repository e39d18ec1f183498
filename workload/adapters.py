"""Views of the test tables in the shape the operators expect.

Each view is one SQL text for both engines. ``$name`` stands for a test table or
another view; the few functions the engines call differently come from
:class:`Dialect`.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


class Dialect(NamedTuple):
    micros: Callable[[str, str], str]
    round_even: Callable[[str, int], str]


SPARK = Dialect(
    lambda a, b: f"timestampdiff(MICROSECOND, {a}, {b})",
    lambda x, n: f"bround({x}, {n})",
)
DUCKDB = Dialect(
    lambda a, b: f"date_diff('microsecond', {a}, {b})",
    lambda x, n: f"round_even({x}, {n})",
)

# the events lie in January 2024
SPAN = ("2024-01-01", "2024-02-29")
# a span of several ISO years
YEARS = ("1994-12-20", "1997-01-10")
SINCE = "1998-01-01"
OBS_SINCE = "2024-01-01"


def _event(date: str, kind: int, columns: str) -> str:
    """Event table made of a sixth of the facts; the six tables hold them all."""
    return f"""
        SELECT patient_num AS patid, cast(start_date AS date) AS {date}, {columns}
        FROM $fx_fact WHERE instance_num % 6 = {kind % 6}"""


@cache
def view_texts(d: Dialect) -> dict[str, str]:
    ident = "cast(encounter_num AS string) || '-' || concept_cd"
    if d is DUCKDB:
        ident = ident.replace("string", "varchar")
    text = "varchar" if d is DUCKDB else "string"
    return {
        "fx_concept": f"""
            SELECT 'C|' || cast(p_partkey AS {text}) AS concept_cd,
                   chr(92) || 'ACT' || chr(92) || p_type || chr(92)
                     || replace(p_brand, '#', '_') || chr(92) AS concept_path,
                   replace(p_brand, 'Brand#', 'J') AS dx_code
            FROM $part""",
        "fx_fact": f"""
            SELECT o_custkey AS patient_num, l_orderkey AS encounter_num,
                   'C|' || cast(l_partkey AS {text}) AS concept_cd, l_linenumber AS instance_num,
                   l_shipdate AS start_date, l_quantity AS nval_num,
                   CASE l_returnflag WHEN 'A' THEN 'E' WHEN 'N' THEN 'L' END AS tval_char
            FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey""",
        "fx_enc": """
            SELECT o_custkey AS patid, o_orderkey AS encounterid,
                   cast(o_orderdate AS date) AS admit_date, '08:00' AS admit_time,
                   CASE WHEN o_orderkey % 29 <> 0
                        THEN cast(o_orderdate AS date) + cast(o_orderkey % 9 AS int) END AS discharge_date,
                   '17:00' AS discharge_time,
                   CASE o_orderstatus WHEN 'F' THEN 'IP' WHEN 'O' THEN 'ED' ELSE 'AV' END AS enc_type,
                   substr(o_orderpriority, 1, 1) AS discharge_disposition,
                   CASE WHEN o_orderkey % 17 = 0 THEN 'EX' ELSE 'HO' END AS discharge_status,
                   o_orderpriority AS admitting_source
            FROM $orders""",
        "fx_dx": f"""
            SELECT e.patid, e.encounterid,
                   {ident.replace("encounter_num", "f.encounter_num").replace("concept_cd", "f.concept_cd")}
                     || '-' || cast(f.instance_num AS {text}) AS diagnosisid,
                   c.dx_code AS dx, cast(f.start_date AS date) AS dx_date,
                   CASE WHEN f.instance_num = 1 THEN 'P' ELSE 'S' END AS pdx,
                   CASE WHEN f.instance_num % 2 = 0 THEN '10' ELSE '09' END AS dx_type,
                   'FI' AS dx_source, 'OD' AS dx_origin, e.admit_date
            FROM $fx_fact f JOIN $fx_concept c ON f.concept_cd = c.concept_cd
            JOIN $fx_enc e ON f.encounter_num = e.encounterid""",
        "fx_keys": """
            SELECT * FROM (VALUES ('J1', 'VIRAL', 'ONE'), ('J25', 'PNEUM', 'TWO'),
                                  ('J7', 'RESP', 'ONE'), ('J7', 'FEVER', 'TWO'))
              AS t(icd_key, dx_ccs_grp1, dx_ccs_grp2)""",
        "fx_demo": """
            SELECT c_custkey AS patid,
                   DATE '1930-01-01' + cast(c_custkey * 37 % 25000 AS int) AS birth_date,
                   CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex,
                   c_mktsegment AS race, CASE WHEN c_custkey % 5 = 0 THEN 'Y' ELSE 'N' END AS hispanic
            FROM $customer""",
        "fx_death": """
            SELECT c_custkey AS patid, DATE '2001-01-01' + cast(c_custkey % 365 AS int) AS death_date
            FROM $customer WHERE c_acctbal < 0""",
        "fx_lab": _event(
            "result_date", 1,
            f"""encounter_num AS encounterid, {ident} AS lab_result_cm_id,
            cast(start_date AS date) AS lab_order_date, cast(start_date AS date) AS specimen_date,
            '07:30' AS specimen_time, '09:10' AS result_time, 'BLD' AS specimen_source,
            nval_num AS result_num, 'K/UL' AS result_unit, concept_cd AS lab_px, 'LC' AS lab_px_type,
            tval_char AS result_modifier, nval_num / 2 AS norm_range_low, 'GE' AS norm_modifier_low,
            nval_num * 2 AS norm_range_high, 'LE' AS norm_modifier_high, concept_cd AS lab_loinc,
            'L' AS result_loc, concept_cd AS raw_lab_name, concept_cd AS raw_lab_code,
            tval_char AS raw_result, 'K/uL' AS raw_unit""",
        ),
        "fx_px": _event(
            "px_date", 2,
            f"""encounter_num AS encounterid, {ident} AS procedureid, 'IP' AS enc_type,
            concept_cd AS px, 'CH' AS px_type, 'OD' AS px_source, tval_char AS ppx""",
        ),
        "fx_vital": _event(
            "measure_date", 3,
            f"""{ident} AS vitalid, '10:00' AS measure_time, nval_num + 100 AS ht, nval_num + 40 AS wt,
            nval_num AS original_bmi, nval_num + 90 AS systolic, nval_num + 50 AS diastolic,
            '04' AS smoking, tval_char AS tabacco""",
        ),
        "fx_pmed": _event(
            "rx_start_date", 4,
            f"""encounter_num AS encounterid, {ident} AS prescribingid, concept_cd AS rxnorm_cui,
            cast(start_date AS date) AS rx_order_date, nval_num AS rx_days_supply,
            instance_num AS rx_refills, '01' AS rx_basis, tval_char AS raw_rx_med_name""",
        ),
        "fx_dmed": _event(
            "dispense_date", 5,
            f"""{ident} AS prescribingid, {ident} AS dispensingid, concept_cd AS ndc,
            nval_num AS dispense_sup, nval_num * 2 AS dispense_amt, concept_cd AS raw_ndc""",
        ),
        "fx_amed": _event(
            "medadmin_start_date", 6,
            f"""encounter_num AS encounterid, {ident} AS prescribingid, {ident} AS medadminid,
            '11:00' AS medadmin_start_time, cast(start_date AS date) AS medadmin_stop_date,
            '12:00' AS medadmin_stop_time, 'RX' AS medadmin_type, concept_cd AS medadmin_code,
            nval_num AS medadmin_dose_admin, 'mg' AS medadmin_dose_admin_unit,
            'IV' AS medadmin_route, tval_char AS medadmin_source""",
        ),
        "fx_obs_codes": f"""
            SELECT concept_cd AS i2b2_code, dx_code AS raw_obsclin_name, concept_cd AS obsclin_code,
                   'LC' AS obsclin_type, concept_path AS i2b2_label
            FROM $fx_concept""",
        "fx_obs": f"""
            SELECT user_id AS patient_num,
                   user_id * 10 + cast(floor((day(ts) - 1) / 10) AS bigint) AS encounter_num,
                   event_type || '|' || cast(event_id % 2 AS {text}) AS concept_cd, 1 AS instance_num,
                   ts AS start_date,
                   CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN value * 8
                        WHEN event_type = 'view' THEN value * 4
                        WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN value * 3
                        WHEN event_type = 'purchase' THEN value * 0.05
                        WHEN event_type = 'signup' THEN cast(floor(event_id / 2) % 14 + 2 AS double)
                        ELSE value END AS nval_num,
                   CASE event_id % 8 WHEN 1 THEN 'Spontaneous' WHEN 3 THEN NULL ELSE 'Assisted' END
                     AS tval_char
            FROM $events""",
        "fx_code_map": """
            SELECT * FROM (VALUES ('view|0', 'PaFiO2'), ('view|1', 'plts'), ('purchase|0', 'br'),
                                  ('purchase|1', 'Scr'), ('signup|0', 'GCS'), ('signup|1', 'Vent_mode'),
                                  ('error|0', 'MAP'), ('error|1', 'Vent_init'))
              AS t(i2b2_code, code)""",
        "fx_stay_times": """
            SELECT patient_num, encounter_num, min(start_date) AS hosp_admsn_dttm,
                   max(start_date) AS hosp_disch_dttm,
                   min(CASE WHEN concept_cd LIKE 'error%' AND encounter_num % 4 <> 3
                            THEN start_date END) AS icu_stay_start_dttm,
                   max(CASE WHEN concept_cd LIKE 'error%' AND encounter_num % 4 <> 3
                            THEN start_date END) AS icu_stay_end_dttm
            FROM $fx_obs GROUP BY patient_num, encounter_num""",
        "fx_stay": f"""
            SELECT patient_num, encounter_num, cast(patient_num % 3 AS int) AS pos_confirmed,
                   CASE WHEN patient_num % 7 = 0 THEN 1 ELSE 0 END AS hosdead,
                   cast(20 + patient_num % 70 AS int) AS age_at_admit,
                   cast(patient_num % 2 AS int) AS sex_female,
                   CASE WHEN encounter_num % 3 = 0 THEN 1 ELSE 0 END AS ed_episode,
                   CASE encounter_num % 5 WHEN 0 THEN 'Emergency' WHEN 1 THEN 'Observation'
                        ELSE 'Inpatient' END AS adt_pat_class,
                   hosp_admsn_dttm, hosp_disch_dttm, icu_stay_start_dttm, icu_stay_end_dttm,
                   {d.micros("icu_stay_start_dttm", "icu_stay_end_dttm")} / 8.64e10
                     AS icu_length_of_stay_days,
                   CASE encounter_num % 6 WHEN 0 THEN 'Skilled Nursing Facility'
                        WHEN 1 THEN 'Home or Self Care' WHEN 2 THEN 'Expired'
                        WHEN 3 THEN 'Home Health Service' WHEN 4 THEN NULL ELSE 'Left' END AS disch_disp,
                   CASE encounter_num % 8 WHEN 0 THEN 'GENERAL SYMPTOMS AND SIGNS'
                        WHEN 1 THEN 'INFLUENZA AND PNEUMONIA'
                        WHEN 2 THEN 'PERSONS WITH POTENTIAL HEALTH HAZARDS RELATED TO DISEASES'
                        WHEN 3 THEN NULL ELSE 'INJURIES' END AS admsn_dx_group
            FROM $fx_stay_times""",
        "fx_bp": f"""
            SELECT o_custkey AS patient_num, l_orderkey AS encounter_num,
                   'BP|' || cast(l_linenumber AS {text}) AS concept_cd, 1 AS instance_num,
                   o_orderdate AS start_date, l_quantity + 60 AS nval_num
            FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey""",
        "fx_bp_codes": """
            SELECT * FROM (VALUES ('BP|1', 'SBP'), ('BP|2', 'DBP'), ('BP|3', 'MAP')) AS t(i2b2_code, code)""",
        "fx_bp_stay": """
            SELECT DISTINCT o_custkey AS patient_num, o_orderkey AS encounter_num FROM $orders""",
        "fx_wbc": """
            SELECT o_custkey AS patient_num, l_orderkey AS encounter_num,
                   'LAB|COMPONENT_ID:' || CASE l_linenumber WHEN 1 THEN '3009' WHEN 2 THEN '3012'
                      WHEN 3 THEN '3016' WHEN 4 THEN '3019' WHEN 5 THEN '3022' WHEN 6 THEN '3025'
                      ELSE '9999' END AS concept_cd,
                   CASE WHEN l_suppkey % 10 = 0 THEN 'L' ELSE 'E' END AS tval_char,
                   CASE WHEN l_partkey % 11 = 0 THEN 'mg/dL' WHEN l_partkey % 2 = 0 THEN 'K/uL'
                        ELSE 'k/ul' END AS units_cd,
                   CASE WHEN l_linenumber = 1 THEN l_quantity / 3 ELSE l_quantity / 10 END AS nval_num,
                   l_shipdate AS start_date,
                   CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS start_since_lab
            FROM $lineitem JOIN $orders ON l_orderkey = o_orderkey""",
        "fx_site": """
            SELECT lower(n_name) AS state, cast(n_nationkey * 1000 AS bigint) AS state_pos,
                   -130 + s_suppkey * 37 % 80 AS site_lon, 20 + s_suppkey * 17 % 40 AS site_lat,
                   s_name AS site_short, s_suppkey * 7 % 200 AS test, s_suppkey % 25 AS pos
            FROM $supplier JOIN $nation ON s_nationkey = n_nationkey""",
        "fx_pred": """
            SELECT (cast(floor(o_totalprice) AS bigint) % 1000) / 1e3 AS pred,
                   CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS real
            FROM $orders""",
        "fx_label_pred": """
            SELECT n_chars / 1e5 AS pred, toxic AS real
            FROM $labels l JOIN $documents d ON l.doc_id = d.doc_id""",
        "fx_page": """
            SELECT page_id, url,
                   '<h3 class="r"><a href="/url?q=' || url || '&sa=U&ved=' || '0">hit</a></h3>'
                   || '<h3><a href="/url?q=' || replace(url, 'http://', 'https://mirror.')
                   || '&sa=U&ved=1">mirror</a></h3>' || html AS html
            FROM $pages""",
        # the forms that an address may have: quoted once or twice, bare, with characters by name
        "fx_page_forms": """
            SELECT page_id, '<!-- <h3><a href="https://comment.org">no</a></h3> -->'
                   || '<h3><a class="x" ' || CASE page_id % 4
                      WHEN 0 THEN 'href=''/url?q=' || replace(url, 'http://', 'https://one.') || '&amp;sa=U&amp;ved=1'''
                      WHEN 1 THEN 'href = "/url?q=' || replace(url, 'http://', 'https://two.') || '&amp;sa=U&amp;ved=1" id=''a'''
                      WHEN 2 THEN 'href=' || replace(url, 'http://', 'https://bare.') || '?a=1&#38;b=2'
                      ELSE 'href="' || replace(url, 'https://', 'http://') || '"' END
                   || '>hit</a></h3>' || html AS html
            FROM $pages""",
    }


def references(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\$(\w+)", text)))


class Views:
    """Test tables and views of one folder as Spark DataFrames, made on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.made: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self.made:
            if name in TABLES:
                self.made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                self.made[name] = self.sql(view_texts(SPARK)[name])
        return self.made[name]

    def sql(self, text: str) -> DataFrame:
        """Run a text whose ``$name`` are tables or views."""
        used = {name: self(name) for name in references(text)}
        return self.spark.sql(re.sub(r"\$(\w+)", r"{\1}", text), **used)


def duckdb_sql(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the views it needs in front of it, as one statement."""
    texts = {**view_texts(DUCKDB), **(extra or {})}
    ordered: dict[str, str] = {}

    def need(text: str) -> None:
        for name in references(text):
            if name in texts and name not in ordered:
                need(texts[name])
                ordered[name] = texts[name]

    need(body)
    plain = lambda text: re.sub(r"\$(\w+)", r"\1", text)
    if not ordered:
        return plain(body)
    views = ",\n".join(f"{name} AS ({plain(text)})" for name, text in ordered.items())
    return f"WITH {views}\n{plain(body)}"
