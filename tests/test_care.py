import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortspark.operators import census as ce
from cohortspark.operators import labs as la
from cohortspark.operators import lookup as lo
from cohortspark.operators import sites as si
from cohortspark.plans import clinical as cl
from cohortspark.sources import refdata

T = dt.datetime
D = dt.date
SPAN = ("2020-03-01", "2020-09-20")


def facts(spark):
    t = T(2020, 5, 1)
    rows = [
        (1, 1, "KX|COMPONENT_ID:3009", "E", "K/uL", 8.0, t, 0), (1, 1, "KX|COMPONENT_ID:3009", "E", "K/uL", 8.0, t, 0),
        (1, 1, "KX|COMPONENT_ID:3016", "E", "k/ul", 2.0, t, 0), (1, 1, "KX|COMPONENT_ID:3012", "E", "K/UL", 16.0, t, 0),
        (1, 1, "KX|COMPONENT_ID:3016", "L", "K/uL", 9.0, t, 0), (1, 1, "KX|COMPONENT_ID:3016", "E", "%", 9.0, t, 0),
        (1, 1, "KX|COMPONENT_ID:9999", "E", "K/uL", 9.0, t, 0), (1, 1, "KX|OTHER:3016", "E", "K/uL", 9.0, t, 0),
        (2, 2, "KX|COMPONENT_ID:3016", "E", "K/uL", 3.0, t, 0), (2, 2, "KX|COMPONENT_ID:3016", "E", "K/uL", 9.6, t, 1),
        (2, 2, "KX|COMPONENT_ID:3009", "E", "K/uL", 0.0, t, 0),
    ]
    return spark.createDataFrame(
        rows,
        "patient_num int, encounter_num int, concept_cd string, tval_char string, units_cd string,"
        " nval_num double, start_date timestamp_ntz, start_since_lab int",
    )


def test_labs(spark, rows):
    ranges = refdata.white_cell_ranges(spark)
    values = la.lab_values(facts(spark), ranges)
    assert values.count() == 6
    out = rows(la.lab_engineered(values, ranges), "patient_num", "wbc_type", "units", "start_since_lab", "nval_num", "nval_fac")
    assert out == sorted(
        [
            (1, "WBC", "K/UL", 0, 8.0, "normal"), (1, "Lymphocyte", "K/UL", 0, 2.0, "low"),
            (1, "Neutrophils", "K/UL", 0, 16.0, "high"), (1, "Lymphocyte", "%", 0, 25.0, "low"),
            (1, "Neutrophils", "%", 0, 0.2, "low"), (1, "Neutrophils-to-Lymph", "ratio", 0, 8.0, None),
            (1, "Lymphocyte-to-Neut", "ratio", 0, 0.125, None), (2, "Lymphocyte", "K/UL", 0, 3.0, "normal"),
            (2, "Lymphocyte", "K/UL", 1, 9.6, "high"), (2, "WBC", "K/UL", 0, 0.0, "low"),
            (2, "Lymphocyte", "%", 0, None, "normal"),
        ],
        key=lambda r: [(v is None, str(type(v)), v) for v in r],
    )
    first = la.lab_initial(la.lab_engineered(values, ranges))
    got = first.where("patient_num = 2 AND wbc_type = 'Lymphocyte' AND units = 'K/UL'").collect()
    assert [r["nval_num"] for r in got] == [9.6]
    spread = {(r["wbc_type"], r["units"]): r for r in la.lab_quantiles(first).collect()}
    assert spread[("Lymphocyte", "K/UL")]["val_50perc"] == pytest.approx(5.8)
    parts = rows(la.lab_percent(values), "patient_num", "nval_num") + rows(la.lab_ratio(values, "Lymphocyte"), "patient_num", "nval_num")
    assert parts == [(1, 0.2), (1, 25.0), (2, None), (1, 8.0)]


def stays(spark):
    rows = [
        (1, 1, 2, 0, "Inpatient", T(2020, 3, 1, 20), T(2020, 3, 1, 23), None, None, 30),
        (2, 2, 2, 1, "Inpatient", T(2020, 3, 1, 8), T(2020, 3, 2, 9), T(2020, 3, 2), 2.9, 50),
        (2, 3, 1, 0, "Emergency", T(2020, 9, 18, 8), T(2020, 10, 30, 9), None, None, 61),
        (3, 4, 0, 0, "Inpatient", T(2020, 4, 1), T(2020, 4, 8), None, None, 40),
        (4, 5, 2, 0, "Inpatient", T(2020, 4, 1), None, T(2020, 4, 2), None, None),
        (5, 6, 2, 0, None, T(2019, 4, 1), T(2019, 5, 8), None, None, 70),
    ]
    df = spark.createDataFrame(
        rows,
        "patient_num int, encounter_num int, pos_confirmed int, ed_episode int, adt_pat_class string,"
        " hosp_admsn_dttm timestamp_ntz, hosp_disch_dttm timestamp_ntz, icu_stay_start_dttm timestamp_ntz,"
        " icu_length_of_stay_days double, age_at_admit int",
    )
    return ce.with_stay_features(df)


def test_incidence_and_census(spark, rows):
    df = stays(spark)
    assert rows(ce.incidence(df, SPAN, "date_month"), "date_rk", "adt_pat_class", "confirmed", "date_to_match") == [
        (3, "Emergency-Inpatient", 1, D(2020, 3, 1)), (3, "Inpatient", 1, D(2020, 3, 1)),
        (4, "Inpatient", 2, D(2020, 4, 1)), (9, "Emergency", 1, D(2020, 9, 18)),
    ]
    assert rows(ce.icu_incidence(df, SPAN, "date_month"), "date_rk", "confirmed") == [(3, 1), (4, 1)]
    # the first counted day is the one after admission; a stay past the span is cut
    assert rows(ce.census(df, SPAN), "date_rk", "adt_pat_class", "confirmed") == [
        (2, "Emergency-Inpatient", 1), (2, "Inpatient", 1), (203, "Emergency", 1), (204, "Emergency", 1),
    ]
    assert rows(ce.icu_census(df, SPAN), "date_rk", "confirmed") == [(3, 1), (4, 1)]


def test_stay_days_total(spark):
    df = stays(spark)
    days = ce.stay_days(df, "hosp_admsn_dttm", "hosp_los", ("2019-01-01", "2021-01-01"), "encounter_num")
    want = sum(max(int(r["hosp_los"]), 1) for r in df.where("hosp_los IS NOT NULL").collect())
    assert days.count() == want


def test_length_of_stay(spark, rows):
    df = stays(spark)
    row = ce.los_summary(df).first()
    assert (row["los_min"], row["los_median"], row["los_max"], row["first_admission"]) == (1.0, 1.0, 1.0, T(2020, 3, 1, 8))
    assert rows(ce.los_buckets(df)) == [("1-4", 2, 2, 2, 2)]


def test_age_trend(spark, rows):
    got = rows(ce.age_trend(stays(spark), SPAN), "date_rk", "icu_ind", "pat_cnt", "age_median", "label")
    assert got == [(1, 0, 1, 30.0, "1,30"), (1, 1, 1, 50.0, "1,50"), (3, 0, 1, 40.0, "1,40"), (3, 1, 1, None, "1,NA"), (16, 0, 1, 61.0, "1,61")] or (
        [r[2:] for r in got] == [(1, 30.0, "1,30"), (1, 50.0, "1,50"), (1, 40.0, "1,40"), (1, None, "1,NA"), (1, 61.0, "1,61")]
    )


def test_demographic_stack(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 2, "Expired", None, 1, 50, None, "Inpatient"), (1, 1, 2, "Expired", None, 1, 50, 3.0, "Inpatient"),
            (1, 1, 2, "Expired", None, 1, 50, 4.0, "Emergency-Inpatient"), (2, 2, 0, None, "BURNS", 0, 60, None, "Inpatient"),
            (3, 3, 1, None, None, 0, 60, None, "Emergency"), (4, 4, 1, None, None, 0, 60, None, None),
        ],
        "patient_num int, encounter_num int, pos_confirmed int, disch_disp string, admsn_dx_group string,"
        " sex_female int, age_at_admit int, icu_length_of_stay_days double, adt_pat_class string",
    )
    out = {r["patient_num"]: r for r in cl.demographic_stack(df.where("pos_confirmed > 0"), df.where("pos_confirmed = 0")).collect()}
    assert sorted(out) == [1, 2]
    assert (out[1]["pos_confirmed"], out[1]["icu_ind"], out[1]["icu_length_of_stay_days"], out[1]["disch_disp_grp"]) == ("POS", 1, 4.0, "DEATH")
    assert (out[2]["pos_confirmed"], out[2]["admsn_dx_grp"], out[2]["disch_disp_grp"]) == ("NEG", "OT", "OT")


def test_sites(spark, rows):
    df = spark.createDataFrame(
        [("ks", -95.0, 39.0, "A", 50, 10), ("ks", -95.0, 39.0, "A", 50, 10), ("mo", -92.0, 38.0, "B", 40, 11),
         ("hi", -157.0, 21.0, "C", 90, 5), ("tx", -99.0, 20.0, "D", 95, 5), ("ia", -93.0, 42.0, "E", None, None)],
        "state string, site_lon double, site_lat double, site_short string, test int, pos int",
    )
    feed = si.site_feed(df, (-125.0, -66.0), (25.0, 49.0))
    assert rows(feed, "label") == [("A:50(< 11)",), ("B:40(11)",)]
    out = si.outside(df, (-125.0, -66.0), (25.0, 49.0))
    assert [r["site_short"] for r in out.collect()] == ["D", "C"]
    assert [r["site_short"] for r in si.outside(df, (-125.0, -66.0), (25.0, 49.0), both_axes=True).collect()] == ["C"]
    regions = spark.createDataFrame([("ks",), ("ny",)], "region string")
    layer = si.state_layer(regions, df.withColumn("state_pos", F.lit(7)).withColumn("state", F.upper("state")))
    assert rows(layer) == [("ks", 7), ("ny", None)]


def test_code_names(spark, rows):
    codes = spark.createDataFrame([("1",), ("2",), ("3",)], "code string")
    names = spark.createDataFrame([("1", "aspirin"), ("2", "x"), ("2", "y")], "code string, name string")
    assert rows(lo.code_names(codes, names, F.concat(F.lit("u/"), F.col("code")))) == [("1", "aspirin"), ("2", "u/2"), ("3", None)]


def test_plans_store_and_model(spark, rows):
    from workload.adapters import SINCE, Views
    from workload.queries import WATERFALL, initial

    v = Views(spark, "/root/testdata/sf0.001")
    tables = {
        "observation_fact": v("fx_fact"), "concept_dimension": v("fx_concept"), "encounter": v("fx_enc"),
        "diagnosis": v("fx_dx"), "demographic": v("fx_demo"), "death": v("fx_death"), "lab": v("fx_lab"),
    }
    spark.sql("CREATE DATABASE IF NOT EXISTS study")
    done = cl.store_cohort(
        tables, v("fx_obs_codes"), "study", since=SINCE, steps=WATERFALL, prefixes=v("fx_keys")
    )
    assert set(done) == {"covid_enc", "covid_eligible_enc", "covid_demo", "covid_dx", "covid_lab", "covid_obsclin"}
    assert spark.table("study.covid_lab").count() == done["covid_lab"].count() > 0
    models = cl.severity_models(initial(Views(spark, "/root/testdata/sf0.01")), drop_negative=True)
    assert len(models) == 6
    for result in models.values():
        assert result.fit.coefficients.count() >= 2 and result.performance.count() == 21
