import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortspark.operators import severity as sv
from cohortspark.plans.clinical import score_severity
from cohortspark.sources import refdata

T = dt.datetime
H = dt.timedelta(hours=1)
ADMIT = T(2020, 5, 1, 8)

EDGES = [
    ("PaFiO2", 400.0, []), ("PaFiO2", 100.0, [3, 4]), ("PaFiO2", 99.9, [4]), ("PaFiO2", 400.1, [0]),
    ("plts", 150.0, []), ("plts", 20.0, [3, 4]), ("br", 32.5, []), ("br", 101.5, []),
    ("br", 204.0, []), ("br", 204.1, [4]), ("br", 19.9, [0]), ("GCS", 9.5, []), ("GCS", 14.0, [1]),
    ("GCS", 15.0, [0]), ("GCS", 6.0, [3]), ("GCS", 5.0, [4]), ("MAP", 70.0, []), ("MAP", 69.0, [1]),
    ("Scr", 5.0, []), ("Scr", 1.2, [1]), ("Scr", 5.1, [4]), ("Scr", None, []),
]


def test_band_edges(spark):
    obs = spark.createDataFrame([(i, c, v) for i, (c, v, _) in enumerate(EDGES)], "i int, code string, nval_num double")
    got = {}
    for r in sv.band_score(obs, refdata.severity_bands(spark)).collect():
        got.setdefault(r["i"], []).append(r["pat_score"])
    assert [sorted(got.get(i, [])) for i in range(len(EDGES))] == [want for _, _, want in EDGES]


def test_band_lint_and_coverage(spark, rows):
    issues = rows(sv.band_lint(refdata.severity_bands(spark)))
    assert ("PaFiO2", 100.0, "overlap") in issues and ("br", 32.5, "gap") in issues
    assert ("MAP", 70.0, "gap") in issues and not [i for i in issues if i[0] == "GCS" and i[1] == 14.0]
    obs = spark.createDataFrame([(c, v) for c, v, _ in EDGES], "code string, nval_num double")
    got = {r["code"]: (r["n_obs"], r["n_unscored"], r["n_once"], r["n_multi"])
           for r in sv.band_coverage(obs, refdata.severity_bands(spark)).collect()}
    assert got["PaFiO2"] == (4, 1, 2, 1) and got["Scr"] == (4, 2, 2, 0)


def stay(patient, encounter, icu=None, icu_end=None, los=None, admit=ADMIT, status=2):
    return (patient, encounter, status, 0, 60, 1, admit, icu, icu_end, los)


STAY_SCHEMA = (
    "patient_num int, encounter_num int, pos_confirmed int, hosdead int, age_at_admit int, sex_female int,"
    " hosp_admsn_dttm timestamp_ntz, icu_stay_start_dttm timestamp_ntz, icu_stay_end_dttm timestamp_ntz,"
    " icu_length_of_stay_days double"
)
FACT_SCHEMA = (
    "patient_num int, encounter_num int, concept_cd string, instance_num int, start_date timestamp_ntz,"
    " nval_num double, tval_char string"
)


@pytest.fixture()
def codes(spark):
    names = ["PaFiO2", "plts", "GCS", "SBP", "DBP", "MAP", "Vent_init", "Vent_mode"]
    return spark.createDataFrame([(f"c|{n}", n) for n in names], "i2b2_code string, code string")


def fact(patient, encounter, code, when, value=None, text=None, instance=1):
    return (patient, encounter, f"c|{code}", instance, when, value, text)


def test_exposure(spark, codes, rows):
    end = ADMIT + 10 * H
    stays = spark.createDataFrame(
        [
            stay(1, 1, ADMIT, end, 1.0), stay(2, 2), stay(3, 3, ADMIT, None, 1.0),
            stay(4, 4, ADMIT, end, 1.0), stay(5, 5),
        ],
        STAY_SCHEMA,
    )
    facts = spark.createDataFrame(
        [
            fact(1, 1, "Vent_init", ADMIT + H), fact(1, 1, "Vent_mode", ADMIT + 3.5 * H, text="AC"),
            fact(1, 1, "Vent_mode", ADMIT + 4 * H, text="SPONTaneous"),
            fact(1, 1, "Vent_mode", ADMIT + 20 * H, text="AC"),  # past intensive care
            fact(2, 2, "Vent_mode", ADMIT), fact(2, 2, "Vent_mode", ADMIT + 2 * H),
            fact(3, 3, "Vent_init", ADMIT + H),  # intensive care without an end
            fact(4, 4, "Vent_init", ADMIT + 4 * H),  # ends with intensive care
            fact(5, 5, "Vent_init", ADMIT),  # no end at all
            fact(9, 9, "Vent_init", ADMIT), fact(1, 1, "Vent_init", T(2019, 1, 1)),
        ],
        FACT_SCHEMA,
    )
    got = rows(sv.exposure_duration(facts, stays, codes, "2020-03-07"))
    assert got == [(1, ADMIT + H, 2.5), (2, ADMIT, 2.0), (4, ADMIT + 4 * H, 6.0)]


def test_derived_map(spark, codes, rows):
    stays = spark.createDataFrame([stay(1, 1)], STAY_SCHEMA)
    facts = spark.createDataFrame(
        [
            fact(1, 1, "SBP", ADMIT, 120.0), fact(1, 1, "DBP", ADMIT, 80.0), fact(1, 1, "DBP", ADMIT, 60.0),
            fact(1, 1, "MAP", ADMIT, 1.0),
            fact(1, 1, "SBP", ADMIT + H, 100.0), fact(1, 1, "MAP", ADMIT + H, 66.0),
            fact(1, 1, "SBP", ADMIT + 2 * H, 100.0), fact(2, 2, "MAP", ADMIT, 50.0),
        ],
        FACT_SCHEMA,
    )
    got = rows(sv.derived_map(facts, stays, codes, "2020-03-07", count_duplicates=True), "start_date", "map", "dup_cells")
    assert got == [(ADMIT, 93.0, 1), (ADMIT + H, 66.0, 0)]


@pytest.fixture()
def result(spark, codes):
    stays = spark.createDataFrame(
        [stay(1, 1, ADMIT, ADMIT + 24 * H, 1.0), stay(1, 2, admit=ADMIT + 100 * H)], STAY_SCHEMA
    )
    facts = spark.createDataFrame(
        [
            fact(1, 1, "PaFiO2", ADMIT - 5 * H, 350.0), fact(1, 1, "PaFiO2", ADMIT, 250.0),
            fact(1, 1, "plts", ADMIT + 12 * H, 30.0), fact(1, 1, "plts", ADMIT + 13 * H, 10.0),
            fact(1, 1, "PaFiO2", ADMIT - 80 * H, 350.0), fact(1, 1, "GCS", ADMIT, 5.0),
            fact(1, 1, "GCS", ADMIT, 14.0),
        ],
        FACT_SCHEMA,
    )
    return score_severity(facts, stays, codes, "2020-03-07")


def test_scored_observations_meet_every_stay_of_the_patient(result):
    hours = {(r["organ"], r["hr_since_admin"]) for r in result.scored.collect()}
    # the second stay begins 100 hours later; its 72 hours reach back to hour 28
    assert ("RESP", -5.0) in hours and ("BLOOD", 13.0) in hours and ("RESP", -80.0) not in hours
    icu = {(r["start_date"], r["hr_since_icu"], r["hr_since_mv"]) for r in result.scored.collect()}
    assert (ADMIT - 5 * H, 0.0, 0.0) in icu and (ADMIT + 13 * H, 13.0, 0.0) in icu


def test_horizons(result):
    got = {}
    for r in result.horizons["admit"].collect():
        got.setdefault(r["hr_since_admin"], {})[r["hr_since_admin_cum"]] = (r["sofa"], r["organ_scored"])
    assert sorted(got[-5.0]) == list(range(1, 13)) and sorted(got[0.0]) == list(range(1, 13))
    assert sorted(got[12.0]) == [12] and 13.0 not in got
    assert got[0.0][1] == (2 + 4, 2) and got[12.0][12] == (3, 1)


def test_cumulative_horizons(result):
    got = {r["hr_since_admin_cum"]: (r["sofa"], r["organ_scored"])
           for r in sv.worst_by_horizon(result.scored, "admit", cumulative=True).collect()}
    assert got[1] == (2 + 4, 2) and got[12] == (2 + 4 + 3, 3)


@pytest.mark.parametrize("clock", ["admit", "icu", "exposure"])
def test_cumulative_horizons_by_a_sweep(spark, codes, clock, rows):
    """Equal to the worst scores over all pairs, for patients with many stays, some open, exposures or none."""
    import random

    draw = random.Random(4)
    times = lambda: ADMIT + draw.randrange(-2000, 20_000) * dt.timedelta(minutes=7)
    stays, facts = [], []
    for patient in range(12):
        for enc in range(draw.randrange(1, 7)):
            start, icu = times(), draw.random() < 0.6
            begin = start + draw.randrange(0, 50) * H if icu else None
            end = begin + draw.randrange(1, 60) * H if icu and draw.random() < 0.9 else None
            days = None if end is None else (end - begin).total_seconds() / 86400
            stays.append(stay(patient, enc, begin, end, days, start if draw.random() < 0.95 else None, draw.randrange(2)))
            for _ in range(draw.randrange(0, 40)):
                code, low, high = draw.choice([("PaFiO2", 50, 500), ("plts", 5, 200), ("GCS", 3, 15)])
                facts.append(fact(patient, enc, code, times(), float(draw.randrange(low, high))))
            if patient % 3 and begin is not None:
                facts.append(fact(patient, enc, "Vent_init", begin + draw.randrange(0, 3) * H, 1.0))
    stays, facts = spark.createDataFrame(stays, STAY_SCHEMA), spark.createDataFrame(facts, FACT_SCHEMA)
    coded = sv.coded_facts(facts, stays, codes, "2000-01-01")
    bands = refdata.severity_bands(spark)
    want = rows(sv.worst_by_horizon(sv.scores_from(coded, stays, bands), clock, cumulative=True))
    got = sv.cumulative_by_horizon(coded, stays, bands, clock)
    assert rows(got) == want and len(want) > 40


def test_running_extremes_over_ranges(spark):
    from cohortspark.operators.ranks import running_extremes

    df = spark.range(4000).select(
        (F.col("id") % 3).alias("g"), F.floor(F.col("id") * 37 % 1009 / 2).alias("t"), F.when(F.col("id") % 5 > 0, F.hash("id")).alias("v"), "id"
    )
    held = [r.asDict() for r in df.collect()]
    for descending in (False, True):
        out = running_extremes(df, ["t"], {"high": "v"}, {"low": "v"}, ["g"], descending)
        assert out.columns == ["g", "t", "v", "id", "high", "low"]
        for r in random_rows(out.collect()):
            near = [x["v"] for x in held if x["g"] == r.g and (x["t"] >= r.t if descending else x["t"] <= r.t) and x["v"] is not None]
            assert (r.high, r.low) == (max(near, default=None), min(near, default=None))


def random_rows(rows):
    import random

    return random.Random(1).sample(rows, 150)


def test_initial_score(result):
    (row,) = result.initial.collect()
    assert (row["sofa_init"], row["sofa_init_since_admin"]) == (1 + 3 + 4, 12.0)


def test_grain(spark, codes):
    assert F is not None
    stays = spark.createDataFrame([stay(1, 1), stay(1, 2)], STAY_SCHEMA)
    facts = spark.createDataFrame([fact(1, 1, "PaFiO2", ADMIT, 250.0)], FACT_SCHEMA)
    count = lambda grain: score_severity(facts, stays, codes, "2020-03-07", grain=grain).scored.count()
    assert (count("patient"), count("encounter")) == (2, 1)
