import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortspark.operators import cohort as co
from cohortspark.operators import extract as ex
from cohortspark.sources import refdata

D = dt.date
T = dt.datetime
STEPS = [
    co.StatusStep(2, 1, ["%POSLAB%"]),
    co.StatusStep(2, 0, ["%DX%"]),
    co.StatusStep(0, 1, ["%NEG%"]),
    co.StatusStep(1, 1, ["%PEND%"]),
]


@pytest.fixture()
def concepts(spark):
    return spark.createDataFrame(
        [("p", r"\a\POSLAB"), ("d", r"\a\DX"), ("n", r"\a\NEG"), ("w", r"\a\PEND"), ("both", r"\NEG\PEND"), ("x", r"\a")],
        "concept_cd string, concept_path string",
    )


@pytest.fixture()
def facts(spark):
    day = T(2020, 5, 1)
    return spark.createDataFrame(
        [
            (1, 10, "p", day), (1, 11, "w", day), (1, 10, "p", day), (2, 20, "n", day),
            (2, 21, "both", day), (3, 30, "w", day), (4, 40, "p", T(2019, 1, 1)), (4, 40, "n", day),
            (5, 50, "x", day), (None, 60, "n", day),
        ],
        "patient_num int, encounter_num int, concept_cd string, start_date timestamp_ntz",
    )


def test_waterfall_keeps_each_patient_at_the_lowest_step(facts, concepts, rows):
    got = rows(co.status_waterfall(facts, concepts, STEPS, "2020-01-01"))
    assert got == [
        (1, 10, 2, 1), (2, 20, 0, 1), (2, 21, 0, 1), (3, 30, 1, 1), (4, 40, 0, 1), (None, 60, 0, 1),
    ]


def test_waterfall_forms_agree(facts, concepts, rows):
    for dedup in (True, False):
        one = rows(co.status_waterfall(facts, concepts, STEPS, "2020-01-01", dedup))
        many = rows(co.status_waterfall_stepwise(facts, concepts, STEPS, "2020-01-01", dedup))
        assert one == many
    assert len(one) == 7


def test_waterfall_reads_the_facts_once(spark, tmp_path, facts, concepts):
    facts.write.parquet(str(tmp_path / "f"))
    df = co.status_waterfall(spark.read.parquet(str(tmp_path / "f")), concepts, STEPS, "2020-01-01")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def test_prefix_match(spark, rows):
    codes = spark.createDataFrame([("J1",), ("J12.9",), ("J",), (None,), ("J7",)], "dx string")
    keys = spark.createDataFrame([("J1", "a"), ("J12", "b"), ("J7", "c"), ("J7", "d")], "icd_key string, g string")
    got = rows(co.prefix_matches(codes, "dx", keys), "dx", "icd_key", "g")
    want = rows(codes.join(keys, F.expr("dx LIKE concat(icd_key, '%')")), "dx", "icd_key", "g")
    assert got == want and len(got) == 5


def test_prefix_match_plans_no_nested_loop(spark):
    codes = spark.range(1000).select(F.col("id").cast("string").alias("dx"))
    keys = refdata.respiratory_prefixes(spark)
    plan = co.prefix_matches(codes, "dx", keys)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def eligible(spark, dedup=True):
    enc = spark.createDataFrame(
        [
            (1, 10, "IP", D(2020, 2, 1)), (2, 20, "ED", D(2020, 2, 1)), (3, 30, "EI", D(2020, 2, 1)),
            (4, 40, "AV", D(2020, 2, 1)), (5, 50, "IP", D(2019, 2, 1)), (6, 60, "IP", D(2020, 2, 1)),
        ],
        "patid int, encounterid int, enc_type string, admit_date date",
    )
    status = spark.createDataFrame(
        [(1, 10, 2, 1), (1, 10, 2, 0), (4, 40, 0, 1), (5, 50, 1, 1)],
        "patient_num int, encounter_num int, pos_confirmed int, lab_int int",
    )
    dx = spark.createDataFrame(
        [
            (2, 20, "J12.1", "10", D(2020, 2, 1)), (2, 20, "J18", "10", D(2020, 2, 1)),
            (3, 30, "J12.1", "09", D(2020, 2, 1)), (6, 60, "Z00", "10", D(2020, 2, 1)),
        ],
        "patid int, encounterid int, dx string, dx_type string, admit_date date",
    )
    keys = refdata.respiratory_prefixes(spark)
    return co.eligible_encounters(enc, status, dx, keys, "2020-01-01", refdata.STAY_TYPES, dedup=dedup)


def test_eligible(spark, rows):
    assert rows(eligible(spark), "patid", "encounterid", "covid_status") == [(1, 10, 2), (2, 20, -1)]
    assert eligible(spark, dedup=False).count() == 3


def test_window_bounds_and_repeats(spark, rows):
    cohort = spark.createDataFrame(
        [
            (1, D(2020, 6, 1), D(2020, 6, 10)), (1, D(2020, 6, 20), D(2020, 6, 25)),
            (2, D(2020, 6, 1), None),
        ],
        "patid int, admit_date date, discharge_date date",
    )
    admit, discharge = D(2020, 6, 1), D(2020, 6, 10)
    days = [
        admit - dt.timedelta(days=366), admit - dt.timedelta(days=365),
        discharge + dt.timedelta(days=30), discharge + dt.timedelta(days=46), D(2020, 6, 21),
    ]
    events = spark.createDataFrame([(1, i, d) for i, d in enumerate(days)] + [(2, 9, admit), (1, 8, None)],
                                   "patid int, e int, day date")
    got = rows(ex.windowed_extract(cohort, events, "day", ["e"]))
    assert got == [(1, 1), (1, 2), (1, 2), (1, 4), (1, 4)]
    once = rows(ex.windowed_extract(cohort, events, "day", ["e"], per_stay=False))
    assert once == [(1, 1), (1, 2), (1, 4)]
    kept = ex.windowed_extract(cohort, events, "day", ["e"], keep=["admit_date"])
    assert kept.columns == ["patid", "e", "admit_date"]


def test_windows_agree_with_the_plain_join(spark, rows):
    cohort = spark.range(60).select(
        (F.col("id") % 7).alias("patid"),
        F.expr("date_add(date'2020-01-01', cast(id * 13 % 700 as int))").alias("admit_date"),
    ).withColumn("discharge_date", F.expr("date_add(admit_date, cast(patid * 40 as int))"))
    events = spark.range(3000).select(
        (F.col("id") % 9).alias("patid"), "id",
        F.expr("date_add(date'2018-01-01', cast(id * 37 % 1800 as int))").alias("day"),
    )
    got = rows(ex.windowed_extract(cohort, events, "day", ["id"]))
    c = cohort.withColumnRenamed("patid", "p")
    want = rows(
        events.join(c, (F.col("patid") == F.col("p"))
                    & F.expr("day between date_sub(admit_date, 365) and date_add(discharge_date, 30)")),
        "patid", "id",
    )
    assert got == want and len(got) > 1000


def test_stored_events_are_pruned_and_stay_in_their_buckets(spark, rows):
    cohort = spark.range(40).select(
        (F.col("id") % 7).alias("patid"),
        F.expr("date_add(date'2020-01-01', cast(id * 13 % 300 as int))").alias("admit_date"),
    ).withColumn("discharge_date", F.when(F.col("patid") == 3, F.lit("9999-12-31").cast("date")).otherwise(F.expr("date_add(admit_date, 5)")))
    events = spark.range(6000).select(
        (F.col("id") % 9).alias("patid"), "id",
        F.when(F.col("id") % 50 > 0, F.expr("date_add(date'2001-01-01', cast(id * 37 % 9000 as int))")).alias("day"),
    )
    ex.store_events(events, "stored_events", "day", buckets=4)
    try:
        near = cohort.where("patid <> 3")
        for stays in (cohort, near):
            assert rows(ex.windowed_extract(stays, "stored_events", "day", ["id"])) == rows(ex.windowed_extract(stays, events, "day", ["id"]))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a large cohort
        out = ex.windowed_extract(near, "stored_events", "day", ["id"])
        text = out._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan parquet") == 1 and text.count("Bucketed: true") == 1
        # the folders are bounded, and only the cohort's side is exchanged
        assert "PartitionFilters: [isnotnull(_quarter" in text and text.count("Exchange hashpartitioning") == 1
        assert out.count() > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS stored_events")


def test_windows_read_the_events_once(spark, tmp_path):
    cohort = spark.createDataFrame([(1, D(2020, 2, 1), D(2020, 2, 9))], "patid int, admit_date date, discharge_date date")
    spark.createDataFrame([(1, 5, D(2020, 2, 3))], "patid int, e int, day date").write.parquet(str(tmp_path / "events"))
    out = ex.windowed_extract(cohort, spark.read.parquet(str(tmp_path / "events")), "day", ["e"])
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert [tuple(r) for r in out.collect()] == [(1, 5)]


def test_demographics_and_history(spark, rows):
    cohort = spark.createDataFrame([(1,), (1,), (2,)], "patid int")
    demo = spark.createDataFrame(
        [(1, D(1950, 1, 1), "F", "01", "N"), (2, D(1960, 1, 1), "M", "02", "Y"), (3, D(1970, 1, 1), "M", "02", "Y")],
        "patid int, birth_date date, sex string, race string, hispanic string",
    )
    death = spark.createDataFrame([(2, D(2020, 9, 9))], "patid int, death_date date")
    assert [r[0] for r in rows(ex.demographics(cohort, demo, death))] == [1, 1, 2]
    assert [r[0] for r in rows(ex.demographics(cohort, demo, death, deceased_only=True))] == [2]
    assert [r[0] for r in rows(ex.demographics(cohort, demo, death, per_stay=False))] == [1, 2]


def test_exclusion_list_with_a_null_excludes_only_its_own(spark):
    left = spark.createDataFrame([(1,), (2,)], "patient_num int")
    listed = spark.createDataFrame([(1,), (None,)], "patient_num int")
    assert left.join(listed, "patient_num", "left_anti").count() == 1
    left.createOrReplaceTempView("l_")
    listed.createOrReplaceTempView("x_")
    assert spark.sql("SELECT * FROM l_ WHERE patient_num NOT IN (SELECT patient_num FROM x_)").count() == 0


def test_case_control_stack(spark, rows):
    cases = spark.createDataFrame([(1, T(2020, 1, 2), 40)], "patient_num int, infection_start_dttm timestamp_ntz, age_at_inf int")
    controls = spark.createDataFrame([(2,)], "patient_num int")
    assert rows(co.case_control_stack(cases, controls)) == [(1, T(2020, 1, 2), 40), (2, T(1900, 1, 1), None)]


def test_hot_patient_stays_whole(spark, rows):
    """A third of all events and stays belong to patient 0."""
    hot = lambda i: F.when(i % 3 == 0, 0).otherwise(i % 11)
    cohort = spark.range(90).select(
        hot(F.col("id")).alias("patid"),
        F.expr("date_add(date'2020-01-01', cast(id * 17 % 900 as int))").alias("admit_date"),
    ).withColumn("discharge_date", F.expr("date_add(admit_date, 5)"))
    events = spark.range(6000).select(
        hot(F.col("id")).alias("patid"), "id",
        F.expr("date_add(date'2018-06-01', cast(id * 41 % 1900 as int))").alias("day"),
    )
    window = F.expr("day between date_sub(admit_date, 365) and date_add(discharge_date, 30)")
    pairs = events.join(cohort.withColumnRenamed("patid", "p"), (F.col("patid") == F.col("p")) & window)
    want = pairs.groupBy("patid", "id").count()
    for limit in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = ex.windowed_extract(cohort, events, "day", ["id"]).groupBy("patid", "id").count()
        assert rows(got) == rows(want)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
