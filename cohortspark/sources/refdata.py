"""Reference tables that come with the library.

They are literals of this file, so the broadcast hint they carry is bounded by
the text below, whatever the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortspark.functions.scalars import biweek
from cohortspark.sources.tables import CODE_MAP_SCHEMA


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """Small table of literal rows, with the hint to broadcast it."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


# Severity bands as (organ, code, lower bound, upper bound,
# direction, score, scale). Directions: l below, le at most, g above, btw
# between. Scale c excludes the upper bound of a between band, d includes it.
SEVERITY_BANDS = [
    ("RESP", "PaFiO2", 400.0, None, "g", 0, "c"),
    ("RESP", "PaFiO2", 300.0, 400.0, "btw", 1, "c"),
    ("RESP", "PaFiO2", 200.0, 300.0, "btw", 2, "c"),
    ("RESP", "PaFiO2", 100.0, 200.0, "btw", 3, "c"),
    ("RESP", "PaFiO2", None, 100.0, "le", 4, "c"),
    ("BLOOD", "plts", 150.0, None, "g", 0, "c"),
    ("BLOOD", "plts", 100.0, 150.0, "btw", 1, "c"),
    ("BLOOD", "plts", 50.0, 100.0, "btw", 2, "c"),
    ("BLOOD", "plts", 20.0, 50.0, "btw", 3, "c"),
    ("BLOOD", "plts", None, 20.0, "le", 4, "c"),
    ("LIVER", "br", None, 20.0, "l", 0, "c"),
    ("LIVER", "br", 20.0, 32.0, "btw", 1, "c"),
    ("LIVER", "br", 33.0, 101.0, "btw", 2, "c"),
    ("LIVER", "br", 102.0, 204.0, "btw", 3, "c"),
    ("LIVER", "br", 204.0, None, "g", 4, "c"),
    ("CNS", "GCS", 14.0, None, "g", 0, "d"),
    ("CNS", "GCS", 13.0, 14.0, "btw", 1, "d"),
    ("CNS", "GCS", 10.0, 12.0, "btw", 2, "d"),
    ("CNS", "GCS", 6.0, 9.0, "btw", 3, "d"),
    ("CNS", "GCS", None, 6.0, "l", 4, "d"),
    ("CARDIO", "MAP", 70.0, None, "g", 0, "c"),
    ("CARDIO", "MAP", None, 70.0, "l", 1, "c"),
    ("RENAL", "Scr", None, 1.2, "l", 0, "c"),
    ("RENAL", "Scr", 1.2, 2.0, "btw", 1, "c"),
    ("RENAL", "Scr", 2.0, 3.5, "btw", 2, "c"),
    ("RENAL", "Scr", 3.5, 5.0, "btw", 3, "c"),
    ("RENAL", "Scr", 5.0, None, "g", 4, "c"),
]

# White-cell components as (type, laboratory name, component id,
# normal low, normal high, normal low percent, normal high percent).
WHITE_CELL_RANGES = [
    ("WBC", "WBC count", "3009", 4.3, 10.0, None, None),
    ("Lymphocyte", "absolute lymph count", "3016", 3.0, 9.5, 40.0, 60.0),
    ("Neutrophils", "absolute neut count", "3012", 1.5, 8.0, 20.0, 40.0),
    ("Monocyte", "absolute mono count", "3019", 0.3, 0.9, 2.0, 8.0),
    ("Eosinophil", "absolute eos count", "3022", 0.0, 0.03, 1.0, 4.0),
    ("Basophil", "absolute baso count", "3025", 0.05, 0.05, 0.5, 1.0),
]

# Diagnosis-code prefixes of infections and respiratory disease
# as (prefix, first group, second group).
RESPIRATORY_PREFIXES = [
    ("A60", "VIRAL", None),
    ("A8", "VIRAL", None),
    ("A9", "VIRAL", None),
    ("B0", "VIRAL", None),
    ("B10", "VIRAL", None),
    ("B25", "VIRAL", None),
    ("B26", "VIRAL", None),
    ("B27", "VIRAL", None),
    ("B33", "VIRAL", None),
    ("B34", "VIRAL", None),
    ("B37", "VIRAL", None),
    ("J12", "VIRAL", None),
    ("J12", "VIRAL", "PNEUM"),
    ("J20.3", "VIRAL", "BRONC"),
    ("J20.4", "VIRAL", "BRONC"),
    ("J20.5", "VIRAL", "BRONC"),
    ("J20.6", "VIRAL", "BRONC"),
    ("J20.7", "VIRAL", "BRONC"),
    ("J21.0", "VIRAL", "BRONC"),
    ("J21.1", "VIRAL", "BRONC"),
    ("J16.8", "PNEUM", None),
    ("J17", "PNEUM", None),
    ("J18", "PNEUM", None),
    ("J85.1", "PNEUM", None),
    ("J95.85", "PNEUM", None),
    ("J09.X1", "PNEUM", "FLU"),
    ("J10.0", "PNEUM", "FLU"),
    ("J11.1", "PNEUM", "FLU"),
    ("J09.X2", "FLU", None),
    ("J09.X3", "FLU", None),
    ("J09.X9", "FLU", None),
    ("J10.1", "FLU", None),
    ("J11.1", "FLU", None),
    ("J20.8", "BRONC", None),
    ("J20.9", "BRONC", None),
    ("J21.8", "BRONC", None),
    ("J21.9", "BRONC", None),
    ("J40", "BRONC", None),
    ("J80", "RESP", None),
    ("J95.82", "RESP", None),
    ("J96", "RESP", None),
    ("R09.2", "RESP", None),
    ("R50.8", "FEVER", None),
]

# Local observation concepts as (name, code, code system, local
# concept, label). Sites replace the local concepts with their own.
OBSERVATION_CODES = [
    ("IMV_init", None, "SCR", "KUH|FLO_MEAS_ID:6687_SEL", "ventilation initial"),
    ("IMV_mode", "20124-4", "LC", "KUH|FLO_MEAS_ID:3309", "ventilation mode"),
    ("IMV_TV", "20112-9", "LC", "KUH|FLO_MEAS_ID:3314", "tidal volume setting"),
    ("IMV_RR", "19834-1", "LC", "KUH|FLO_MEAS_ID:3318", "respiratory rate setting"),
    ("IMV_PEEP", "20077-4", "LC", "KUH|FLO_MEAS_ID:3326", "positive end expiratory pressure"),
    ("ETVS", "20107-9", "LC", "KUH|FLO_MEAS_ID:3315", "expired tidal volume spontaneous"),
    ("INTUBE", "33443-3", "LC", "LDA|2118:700", "endotracheal tube placement date"),
    ("INTUBE", "33443-3", "LC", "LDA|4537:700", "nasalendotracheal tube placement date"),
    ("INTUBE", "33443-3", "LC", "LDA|2095:700", "tracheostomy tube placement date"),
    ("INTUBE", "33443-3", "LC", "LDA|4567:700", "oralendotracheal tube placement date"),
    ("RR", "9279-1", "LC", "KUH|FLO_MEAS_ID:9", "respiratory rate"),
    ("RR", "9279-1", "LC", "KUH|FLO_MEAS_ID:1190", "respiratory rate"),
    ("TEMP", "8310-5", "LC", "KUH|FLO_MEAS_ID:6", "temperature"),
    ("HR", "8867-4", "LC", "KUH|FLO_MEAS_ID:8", "heart rate"),
    ("GCS", "35088-4", "1005", "@", "Glascow Coma scale"),
    ("SpO2", "2708-6", "LC", "KUH|FLO_MEAS_ID:10", "SpO2"),
    ("FiO2", "19996-8", "LC", "KUH|FLO_MEAS_ID:10124", "FiO2"),
    ("FiO2", "19996-8", "14447", "mmHg", "FiO2"),
    ("FiO2", "19996-8", "LC", "KUH|FLO_MEAS_ID:301550", "FiO2"),
    ("PaO2", "2703-7", "9518", "mmHg", "PaO2"),
    ("PaFiO2", "50983-6", "LC", "KUH|FLO_MEAS_ID:4916", "PaO2/FiO2"),
]

# Concept-path patterns of the status steps, in order, as
# (status, from a laboratory, patterns). 2 positive, 0 negative, 1 pending.
STATUS_STEPS = [
    (
        2,
        1,
        [
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0022885\UMLS_C1335447%",
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0022885\ACT_LOCAL_LAB_ANY_POSITIVE%",
        ],
    ),
    (
        2,
        0,
        [
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0037088\SNOMED_3947183016%",
            r"%ICD10%U07.1%",
        ],
    ),
    (
        0,
        1,
        [
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0022885\UMLS_C1334932%",
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0022885\ACT_LOCAL_LAB_ANY_NEGATIVE%",
        ],
    ),
    (
        1,
        1,
        [
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0022885\UMLS_C1611271%",
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0022885\UMLS_C4303880%",
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0022885\ACT_LOCAL_LAB_ANY_PENDING%",
            r"%ACT\UMLS_C0031437\SNOMED_3947185011\UMLS_C0022885\ACT_LOCAL_LAB_ANY_EQUIVOCAL%",
        ],
    ),
]

# Visit types that count as a hospital stay.
STAY_TYPES = ("ED", "EI", "IP")

# Discharge groups as (pattern in the lower-cased text, label),
# the first that holds wins; then the admission groups kept as they are and the
# phrase reduced to itself; then the status labels.
DISCHARGE_RULES = [
    ("nursing|hospice|rehap|long term care|home health", "SNF-HOSP-REHAP-LTC-HHA"),
    ("home or self", "HOME"),
    ("expired", "DEATH"),
]
ADMISSION_GROUPS = [
    "GENERAL SYMPTOMS AND SIGNS",
    "OTHER BACTERIAL DISEASES",
    "SYMPTOMS AND SIGNS INVOLVING THE CIRCULATORY AND RESPIRATORY SYSTEMS",
    "SYMPTOMS AND SIGNS INVOLVING THE DIGESTIVE SYSTEM AND ABDOMEN",
    "INFLUENZA AND PNEUMONIA",
]
ADMISSION_PHRASES = ["PERSONS WITH POTENTIAL HEALTH HAZARDS"]
STATUS_LABELS = {2: "POS", 0: "NEG", 1: "PEND"}

BAND_SCHEMA = "organ string, code string, lb double, ub double, direction string, score int, scale_type string"
RANGE_SCHEMA = (
    "wbc_type string, lab_name string, component_id string, normal_low double,"
    " normal_high double, normal_lowp double, normal_highp double"
)


def severity_bands(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SEVERITY_BANDS, BAND_SCHEMA)


def white_cell_ranges(spark: SparkSession) -> DataFrame:
    return literal_table(spark, WHITE_CELL_RANGES, RANGE_SCHEMA)


def respiratory_prefixes(spark: SparkSession) -> DataFrame:
    rows = literal_table(
        spark, RESPIRATORY_PREFIXES, "icd_key string, dx_ccs_grp1 string, dx_ccs_grp2 string"
    )
    return rows.distinct()


def observation_codes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, OBSERVATION_CODES, CODE_MAP_SCHEMA).distinct()


def misplaced_codes(code_map: DataFrame) -> DataFrame:
    """Rows of a code map whose local concept cannot be one: no ``|`` or ``:`` in it."""
    return code_map.where(~F.col("i2b2_code").rlike(r"[|:]"))


def calendar(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day and scale: ``date``, ``date_scale`` and the rank ``date_rk``.

    Scales are days, ISO weeks, two-week spans and months. Weeks are ranked by
    ISO year and number, so a span may cross years; months keep their number.
    """
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
        ).alias("date")
    )
    ranked = days.select(
        "date",
        F.dense_rank().over(W.orderBy("date")).cast("long").alias("date_daily"),
        F.dense_rank().over(W.orderBy(F.extract(F.lit("YEAROFWEEK"), F.col("date")), F.weekofyear("date"))).cast("long").alias("date_week"),
        F.month("date").cast("long").alias("date_month"),
    ).withColumn("date_biweek", biweek(F.col("date_week")).cast("long"))
    scales = ["date_daily", "date_week", "date_biweek", "date_month"]
    return F.broadcast(ranked.unpivot("date", scales, "date_scale", "date_rk"))
