"""Tables of the cohort: demographics, diagnoses, and events around each stay.

The cohort is read by every extract, so it should be a stored table or a checkpoint.
Joins are left to adaptive execution, which broadcasts by measured bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.operators.cohort import in_cohort


class EventTable(NamedTuple):
    """How to extract one event table: its date column and the columns to keep."""

    date: str
    columns: tuple[str, ...]
    before: int = 365
    after: int = 30


# Date and output columns of the windowed event tables.
EVENT_TABLES = {
    "lab": EventTable(
        "result_date",
        (
            "encounterid", "lab_result_cm_id", "lab_order_date", "specimen_date", "specimen_time",
            "result_date", "result_time", "specimen_source", "result_num", "result_unit", "lab_px",
            "lab_px_type", "result_modifier", "norm_range_low", "norm_modifier_low",
            "norm_range_high", "norm_modifier_high", "lab_loinc", "result_loc", "raw_lab_name",
            "raw_lab_code", "raw_result", "raw_unit",
        ),
    ),
    "px": EventTable(
        "px_date",
        ("encounterid", "procedureid", "enc_type", "px_date", "px", "px_type", "px_source", "ppx"),
    ),
    "vital": EventTable(
        "measure_date",
        (
            "vitalid", "measure_date", "measure_time", "ht", "wt", "original_bmi", "systolic",
            "diastolic", "smoking", "tabacco",
        ),
    ),
    "pmed": EventTable(
        "rx_start_date",
        (
            "encounterid", "prescribingid", "rxnorm_cui", "rx_order_date", "rx_start_date",
            "rx_days_supply", "rx_refills", "rx_basis", "raw_rx_med_name",
        ),
    ),
    "dmed": EventTable(
        "dispense_date",
        (
            "prescribingid", "dispensingid", "ndc", "dispense_date", "dispense_sup",
            "dispense_amt", "raw_ndc",
        ),
    ),
    "amed": EventTable(
        "medadmin_start_date",
        (
            "encounterid", "prescribingid", "medadminid", "medadmin_start_date",
            "medadmin_start_time", "medadmin_stop_date", "medadmin_stop_time", "medadmin_type",
            "medadmin_code", "medadmin_dose_admin", "medadmin_dose_admin_unit", "medadmin_route",
            "medadmin_source",
        ),
    ),
}

_BIN_DAYS = 90
#: quarters after the latest window's first day that are told apart; all that is later is one
_LATER = 40
#: column that an event store is laid out in folders by, and bucketed by beside the patient
QUARTER, BIN = "_quarter", "_bin"


def _bin(day) -> F.Column:
    return F.floor(F.unix_date(day) / F.lit(_BIN_DAYS))


def store_events(
    events: DataFrame, name: str, date: str, patient: str = "patid", buckets: int = 200
) -> DataFrame:
    """Catalog table ``name`` of the events: a folder for each quarter, bucketed by patient and quarter.

    Windowed extracts of it read only the folders of the cohort's windows, and join them without an
    exchange of the events; a patient with very many events is in as many buckets as quarters. The
    table has two columns more, :data:`QUARTER` and :data:`BIN`. It replaces one of the same name.
    """
    rows = events.withColumn(BIN, _bin(F.col(date).cast("date"))).withColumn(QUARTER, F.col(BIN))
    (
        rows.repartition(buckets, patient, BIN)
        .write.mode("overwrite")
        .format("parquet")
        .partitionBy(QUARTER)
        .bucketBy(buckets, patient, BIN)
        .sortBy(patient, BIN)
        .saveAsTable(name)
    )
    return events.sparkSession.table(name)


def windowed_extract(
    cohort: DataFrame,
    events: DataFrame | str,
    date: str,
    columns: Sequence[str],
    before: int = 365,
    after: int = 30,
    per_stay: bool = True,
    keep: Sequence[str] = (),
    patient: str = "patid",
) -> DataFrame:
    """Events of each patient from ``before`` days ahead of admission to ``after`` days past discharge.

    An event is repeated for every stay whose window holds it, with the ``keep``
    columns of that stay; ``per_stay=False`` gives each event once and keeps none.
    Open stays have no window. ``events`` is a frame, or the name of a table that :func:`store_events` wrote.

    The join runs on patient and quarter of a year, not on the patient alone: a
    patient with very many events is spread over many keys, and only pairs whose
    quarters meet are ever compared. The earliest and the latest window bound the
    dates that are scanned, which is done once; of a stored table they bound the
    folders. Quarters long after all admissions count as one,
    so a discharge far in the future costs little.
    """
    windows = cohort.select(
        patient,
        *keep,
        F.date_sub("admit_date", before).alias("_from"),
        F.date_add("discharge_date", after).alias("_to"),
    ).where(F.col("_to") >= F.col("_from"))
    name = events if isinstance(events, str) else None
    events = cohort.sparkSession.table(name) if name else events
    kind = events.schema[date].dataType
    # a time of the last day is before the next one
    edges = windows.agg(
        F.min("_from").alias("a"), F.max("_to").alias("b"), (_bin(F.max("_from")) + _LATER).alias("cap")
    )
    first, last = edges.select(F.col("a").cast(kind)).scalar(), edges.select(F.date_add("b", 1).cast(kind)).scalar()
    near = events.where((F.col(date) >= first) & (F.col(date) <= last))
    if name:
        low, high = edges.select(_bin("a")).scalar(), edges.select(_bin("b")).scalar()
        near = near.where(F.col(QUARTER).between(low, high))
        # no window lists a quarter beyond the folders there are
        capped = F.least(_bin("_to"), F.lit(_last_quarter(cohort.sparkSession, name)))
    else:
        cap = edges.select("cap").scalar()
        near = near.withColumn(BIN, F.least(_bin(F.col(date).cast("date")), cap))
        capped = F.least(_bin("_to"), cap)
    bounds = windows.withColumn("_until", capped).where(F.col("_until") >= _bin("_from"))
    bounds = bounds.withColumn(BIN, F.explode(F.sequence(_bin("_from"), F.col("_until"))))
    e, b = near.alias("e"), bounds.alias("b")
    condition = (
        (F.col(f"e.{patient}") == F.col(f"b.{patient}"))
        & (F.col(f"e.{BIN}") == F.col(f"b.{BIN}"))
        & F.col(f"e.{date}").between(F.col("b._from"), F.col("b._to"))
    )
    joined = e.join(b, condition, "inner" if per_stay else "left_semi")
    carried = [F.col(f"b.{c}") for c in keep] if per_stay else []
    return joined.select(F.col(f"e.{patient}"), *(F.col(f"e.{c}") for c in columns), *carried)


def _last_quarter(spark: SparkSession, name: str) -> int:
    """The latest quarter among the folders of a stored table, which the catalog lists."""
    folders = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": name})
    quarter = F.regexp_extract("partition", rf"{QUARTER}=(-?\d+)", 1)
    return folders.where(quarter != "").agg(F.max(quarter.cast("int"))).first()[0] or 0


def extract_events(
    cohort: DataFrame,
    events: DataFrame | str,
    table: str,
    date: str | None = None,
    per_stay: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Windowed extract of one of :data:`EVENT_TABLES`; ``date`` replaces its date column."""
    spec = EVENT_TABLES[table]
    return windowed_extract(
        cohort, events, date or spec.date, spec.columns, spec.before, spec.after, per_stay, keep
    )


def extract_observations(
    cohort: DataFrame,
    facts: DataFrame,
    code_map: DataFrame,
    before: int = 30,
    after: int = 30,
    per_stay: bool = True,
) -> DataFrame:
    """Clinical observations around each stay, named through the code map."""
    names = code_map.select(
        F.col("i2b2_code").alias("concept_cd"), "obsclin_type", "obsclin_code", "raw_obsclin_name"
    )
    coded = facts.join(names, "concept_cd").select(
        F.col("patient_num").alias("patid"),
        F.col("encounter_num").alias("encounterid"),
        F.col("start_date").alias("obsclin_date_time"),
        F.col("nval_num").alias("obsclin_result_num"),
        F.col("tval_char").alias("obsclin_result_text"),
        "obsclin_type",
        "obsclin_code",
        "raw_obsclin_name",
    )
    return windowed_extract(
        cohort, coded, "obsclin_date_time", coded.columns[1:], before, after, per_stay
    )


def _repeated(cohort: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` of cohort patients, each as often as its patient has stays in the cohort."""
    stays = cohort.groupBy("patid").agg(F.count(F.lit(1)).cast("int").alias("_stays"))
    once = F.explode(F.sequence(F.lit(1), F.col("_stays")))
    return rows.join(stays, "patid").withColumn("_copy", once).drop("_stays", "_copy")


def demographics(
    cohort: DataFrame,
    demographic: DataFrame,
    death: DataFrame,
    deceased_only: bool = False,
    per_stay: bool = True,
) -> DataFrame:
    """Demographics with the death date, which the living lack.

    ``deceased_only`` keeps patients with a death record. One row per stay, or
    one per patient with ``per_stay=False``.
    """
    rows = demographic.join(
        death.select("patid", "death_date"), "patid", "inner" if deceased_only else "left"
    ).select("patid", "birth_date", "sex", "race", "hispanic", "death_date")
    if per_stay:
        return _repeated(cohort, rows)
    return in_cohort(rows, cohort, ["patid"])


def diagnosis_history(cohort: DataFrame, diagnoses: DataFrame, per_stay: bool = False) -> DataFrame:
    """All diagnoses of the cohort's patients, whatever their date.

    Each once: the rows hold nothing of the stay itself, so a patient's stays
    would only repeat them, as ``per_stay=True`` does.
    """
    rows = diagnoses.select(
        "patid", "encounterid", "diagnosisid", "dx", "dx_date", "pdx", "dx_type", "dx_source",
        "dx_origin",
    )
    if per_stay:
        return _repeated(cohort, rows)
    return in_cohort(rows, cohort, ["patid"])
