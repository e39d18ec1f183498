import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.operators import compare as cm
from cohortspark.operators import evaluate as ev
from cohortspark.operators.regress import fit_glm, fitted
from cohortspark.operators.reshape import gather


def predictions(spark, pairs):
    return spark.createDataFrame([(float(p), int(y)) for p, y in pairs], "pred double, real int")


@pytest.fixture(scope="module")
def tied():
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.35).astype(int)
    p = np.round(np.clip(0.35 + 0.15 * y + rng.normal(0, 0.2, 400), 0, 1), 2)
    return list(zip(p, y))


def pair_auc(pairs):
    pos = np.array([p for p, y in pairs if y == 1])
    neg = np.array([p for p, y in pairs if y == 0])
    wins = (pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])
    var = wins.mean(1).var(ddof=1) / len(pos) + wins.mean(0).var(ddof=1) / len(neg)
    return wins.mean(), math.sqrt(var)


def test_auc_equals_the_pairwise_one(spark, tied):
    auc, se = pair_auc(tied)
    row = ev.roc_auc_ci(ev.score_counts(predictions(spark, tied))).first()
    assert row["roauc"] == pytest.approx(auc, abs=1e-12)
    assert row["roauc_low"] == pytest.approx(auc - 1.959963984540054 * se, abs=1e-12)
    turned = [(1 - p, y) for p, y in tied]
    assert ev.roc_auc_ci(ev.score_counts(predictions(spark, turned))).first()["roauc"] == pytest.approx(auc, abs=1e-9)


def test_auc_extremes(spark):
    auc = lambda pairs: tuple(ev.roc_auc_ci(ev.score_counts(predictions(spark, pairs))).first())
    assert auc([(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)]) == (1.0, 1.0, 1.0)
    assert auc([(0.9, 1), (0.8, 1)]) == (None, None, None)
    assert auc([(0.5, 1), (0.5, 0), (0.5, 1), (0.5, 0)])[1] == 0.5


def stepped(pairs):
    """Davis-Goadrich area, point by point."""
    pos = sum(y for _, y in pairs)
    cuts = sorted({p for p, _ in pairs}, reverse=True)
    points = [(0, 0)] + [
        (sum(1 for p, y in pairs if p >= c and y), sum(1 for p, y in pairs if p >= c and not y)) for c in cuts
    ]
    area = smooth = 0.0
    for (t0, f0), (t1, f1) in itertools.pairwise(points):
        if t1 == t0:
            continue
        h = (f1 - f0) / (t1 - t0)
        prec = lambda x: x / (x + f0 + h * (x - t0)) if x + f0 + h * (x - t0) else 1 / (1 + h)
        area += sum((prec(x) + prec(x + 1)) / 2 for x in range(t0, t1))
        grid = np.linspace(t0, t1, 200_001)
        grid[0] += 1e-12
        vals = grid / (grid + f0 + h * (grid - t0))
        smooth += float(np.sum((vals[1:] + vals[:-1]) / 2) * (t1 - t0) / 200_000)
    return smooth / pos, area / pos


def test_pr_areas(spark, tied):
    for pairs in (tied, [(round(p, 1), y) for p, y in tied], [(0.5, y) for _, y in tied]):
        smooth, area = stepped(pairs)
        row = ev.pr_auc(ev.score_counts(predictions(spark, pairs))).first()
        assert row["prauc1"] == pytest.approx(smooth, abs=1e-6)
        assert row["prauc2"] == pytest.approx(area, abs=1e-9)


def test_pr_area_of_long_tied_runs(spark):
    pairs = [(0.9, 0)] * 50 + [(0.8, 1)] * 900 + [(0.8, 0)] * 1700 + [(0.4, 1)] * 700 + [(0.4, 0)] * 10
    smooth, area = stepped(pairs)
    row = ev.pr_auc(ev.score_counts(predictions(spark, pairs))).first()
    assert row["prauc2"] == pytest.approx(area, abs=1e-9)
    assert row["prauc1"] == pytest.approx(smooth, abs=1e-6)


def test_sweep(spark):
    pairs = [(0.9, 1), (0.8, 0), (0.7, 1), (0.3, 0), (0.2, 0)]
    got = {r["cutoff"]: r for r in ev.threshold_sweep(ev.score_counts(predictions(spark, pairs))).collect()}
    assert sorted(got) == [0.3, 0.7, 0.8, 0.9]  # the lowest cutoff has no specificity
    r = got[0.7]
    assert (r["prec"], r["rec_sens"], r["spec"], r["acc"]) == pytest.approx((2 / 3, 1.0, 2 / 3, 0.8))
    assert r["mcc"] == pytest.approx((2 * 2 - 0) / math.sqrt(3 * 2 * 3 * 2)) and r["pcfall"] == pytest.approx(1 / 3)
    assert r["fscore"] == pytest.approx(0.8) and r["npv"] == 1.0 and r["size"] == 1
    point = ev.operating_point(ev.threshold_sweep(ev.score_counts(predictions(spark, pairs)))).first()
    assert point["opt_thresh"] == 0.7
    assert ev.threshold_sweep(ev.score_counts(predictions(spark, [(0.5, 1), (0.5, 0)]))).count() == 0


def test_summary_has_all_measures(spark, tied):
    names = {r["overall_meas"] for r in ev.perf_summary(predictions(spark, tied)).collect()}
    assert len(names) == 21 and {"roauc", "opt_thresh", "prauc2", "mcc_m"} <= names


def test_calibration(spark, tied):
    out = ev.calibration(predictions(spark, tied)).collect()
    assert sum(r["expos"] for r in out) == len(tied) and sum(r["y_agg"] for r in out) == sum(y for _, y in tied)
    few = ev.calibration(predictions(spark, [(0.1, 0)] * 50 + [(0.2, 1)] * 3 + [(0.9, 1)] * 2)).collect()
    assert sum(r["expos"] for r in few) == 55 and len(few) < 5
    for r in out:
        half = 1.96 * math.sqrt(r["y_p"] * (1 - r["y_p"]) / r["expos"])
        assert r["binci_upper"] == pytest.approx(r["pred_p"] + half)
        assert r["binci_lower"] == pytest.approx(max(0, r["pred_p"] - half))


def test_calibration_bins_close_on_the_right(spark):
    values = np.arange(101) / 100
    out = sorted(ev.calibration(predictions(spark, [(v, 0) for v in values]), n_bin=4).collect(), key=lambda r: r["pred_bin"])
    assert [(r["bin_lower"], r["bin_upper"], r["expos"]) for r in out] == [
        (0.0, 0.25, 26), (0.26, 0.5, 25), (0.51, 0.75, 25), (0.76, 1.0, 25),
    ]
    assert [r["bin_mid"] for r in out] == pytest.approx([0.125, 0.38, 0.63, 0.88])


# ------------------------------------------------------------ group comparison

ROWS = [
    (1, "A", 1.0, "x", None), (2, "A", 2.0, "x", None), (3, "A", 3.0, "y", None), (3, "A", 5.0, "x", None),
    (4, "B", 4.0, "y", None), (5, "B", None, None, None), (6, "B", 6.0, "y", None), (7, None, 9.0, "x", None),
]


@pytest.fixture()
def study(spark):
    return spark.createDataFrame(ROWS, "id int, grp string, a double, c string, empty double")


def test_profiles(study):
    got = {(r["var"], r["grp"]): r for r in cm.numeric_profile(study, "id", "grp", ["a", "empty"]).collect()}
    a = got[("a", "A")]
    assert (a["n"], a["val_miss"], a["val_mean"], a["val_med"], a["val_q1"]) == (3, 0, 2.75, 2.5, 1.75)
    assert a["label"] == "3; 2.75(1.708); 2.5(1.75,3.5)"
    assert got[("a", "B")]["val_miss"] == 1 and got[("empty", "A")]["val_mean"] is None
    assert ("a", None) in got
    cats = {(r["grp"], r["val"]): r for r in cm.categorical_profile(study, "id", "grp", ["c"]).collect()}
    # patient 3 counts under both levels
    assert (cats[("A", "x")]["n"], cats[("A", "y")]["n"], cats[("A", "x")]["tot"]) == (3, 1, 3)
    assert cats[("B", "y")]["val_miss"] == 1 and cats[("A", "x")]["label"] == "3; (100%)"
    within = {(r["grp"], r["val"]): r["val_miss"] for r in cm.categorical_profile(study, "id", "grp", ["c"], "group").collect()}
    assert within[("A", "x")] == 0 and within[("B", "y")] == 1


def test_anova(study):
    long = gather(study, ["grp"], ["a", "empty"], "double")
    out = {r["var"]: r for r in cm.anova_p(cm.anova(cm.group_moments(long))).collect()}
    a, b = np.array([1.0, 2, 3, 5]), np.array([4.0, 6])
    both = np.concatenate([a, b])
    between = sum(len(g) * (g.mean() - both.mean()) ** 2 for g in (a, b))
    within = sum(((g - g.mean()) ** 2).sum() for g in (a, b))
    assert out["a"]["f_value"] == pytest.approx(between / (within / 4))
    t = math.sqrt(between / (within / 4))
    assert 0 < out["a"]["p_value"] < 1 and t > 0
    assert "empty" not in out


def test_chi_square(spark):
    table = {("x", "A"): 30, ("x", "B"): 10, ("y", "A"): 20, ("y", "B"): 40, ("z", "A"): 5}
    rows = [(v, g) for (v, g), n in table.items() for _ in range(n)] + [(None, "A")]
    long = spark.createDataFrame(rows, "val string, grp string").withColumn("var", F.lit("c"))
    cells = cm.contingency(long.unionByName(long.withColumn("val", F.lit("one")).withColumn("var", F.lit("flat"))))
    out = {r["var"]: r for r in cm.chi_square(cells).collect()}
    grid = np.array([[30, 10], [20, 40], [5, 0]], float)
    expected = grid.sum(1, keepdims=True) * grid.sum(0, keepdims=True) / grid.sum()
    assert out["c"]["chisq"] == pytest.approx(((grid - expected) ** 2 / expected).sum()) and out["c"]["df"] == 2
    p = {r["var"]: r["p_value"] for r in cm.chi_square_p(cells, replicates=500).collect()}
    assert p["c"] == pytest.approx(1 / 501) and "flat" not in p
    again = {r["var"]: r["p_value"] for r in cm.chi_square_p(cells, replicates=500).collect()}
    assert p == again


def test_monte_carlo_p_is_near_the_asymptotic_one(spark):
    rng = np.random.default_rng(0)
    rows = [(str(v), str(g)) for v, g in zip(rng.integers(0, 2, 300), rng.integers(0, 2, 300))]
    long = spark.createDataFrame(rows, "val string, grp string").withColumn("var", F.lit("c"))
    cells = cm.contingency(long)
    stat = cm.chi_square(cells).first()["chisq"]
    exact = math.erfc(math.sqrt(stat / 2))  # upper tail for one degree of freedom
    p = cm.chi_square_p(cells, replicates=3000).first()["p_value"]
    assert abs(p - exact) < 0.09


def test_report_layout(study):
    table = cm.comparison_table(study, "id", "grp", ["a"], ["c"], ["A", "B"], replicates=200)
    got = [tuple(r) for r in table.collect()]
    assert table.columns == ["var", "cat", "A", "B", "p.value"]
    assert got[0] == ("n", "", "3", "3", None)
    assert got[1][:4] == ("a", "mean(sd) [miss]", "2.8 (1.7) [0]", "5 (1.4) [0.33]")
    assert got[2][:4] == ("c", "x,n(%) [miss]", "3 (100%) [0.33]", None)
    assert got[3][:4] == ("c", "y,n(%) [miss]", "1 (33.3%) [0.33]", "2 (66.7%) [0.33]")


def test_glm(spark):
    # one 0/1 predictor: the coefficients are logs of odds
    counts = {(1, 1): 30, (1, 0): 10, (0, 1): 15, (0, 0): 45}
    df = spark.createDataFrame([k for k, n in counts.items() for _ in range(n)], "x int, y int")
    fit = fit_glm(df, "y", ["x"])
    got = {r["term"]: (r["estimate"], r["std_error"]) for r in fit.coefficients.collect()}
    assert got["x"] == pytest.approx((math.log(30 * 45 / (10 * 15)), math.sqrt(1 / 30 + 1 / 10 + 1 / 15 + 1 / 45)), abs=1e-6)
    assert got["(Intercept)"][0] == pytest.approx(math.log(15 / 45), abs=1e-6)
    assert fit.goodness.first()["df_residual"] == 98
    pred = {round(r["pred"], 6) for r in fitted(fit, df, "y").collect()}
    assert pred == {0.75, 0.25}


def test_glm_with_levels_and_counts(spark):
    df = spark.createDataFrame(
        [(s, y) for s, ys in ((0, (1, 2, 3)), (1, (4, 6)), (2, (9, 11))) for y in ys] + [(None, 4)], "s int, y int"
    )
    fit = fit_glm(df, "y", ["s"], "poisson", categorical=["s"])
    got = {r["term"]: r["estimate"] for r in fit.coefficients.collect()}
    assert got["(Intercept)"] == pytest.approx(math.log(2), abs=1e-6)
    assert got["s_1"] == pytest.approx(math.log(5 / 2), abs=1e-6) and got["s_2"] == pytest.approx(math.log(5), abs=1e-6)
    out = fitted(fit, df, "y", "y >= 5").collect()
    assert len(out) == 7 and sum(r["real"] for r in out) == 3


def test_monte_carlo_beyond_what_can_be_drawn(spark):
    big = 10**9
    cells = spark.createDataFrame(
        [("c", "x", "A", big), ("c", "x", "B", big), ("c", "y", "A", big), ("c", "y", "B", big + 100_000)],
        "var string, val string, grp string, o long",
    )
    stat = cm.chi_square(cells).first()["chisq"]
    p = cm.chi_square_p(cells).first()["p_value"]
    assert abs(p - math.erfc(math.sqrt(stat / 2))) < 0.05


def test_draws_follow_the_hypergeometric_distribution():
    import numpy as np

    from cohortspark.functions.draws import dealt, hypergeometric, stirling_remainder

    rng = np.random.default_rng(3)
    n = np.arange(1, 200)
    want = [math.lgamma(k + 1) - ((k + 0.5) * math.log(k) - k + 0.5 * math.log(2 * math.pi)) for k in n.tolist()]
    assert np.allclose(stirling_remainder(n), want, atol=1e-12) and stirling_remainder(np.array([0]))[0] == 0
    for good, bad, sample in ((5, 7, 4), (1, 9, 10), (3, 0, 2), (0, 4, 2), (40, 200, 60), (900, 5, 880)):
        got = np.bincount(hypergeometric(rng, np.full(20_000, good), bad, sample), minlength=good + 1) / 20_000
        want = [math.comb(good, k) * math.comb(bad, sample - k) / math.comb(good + bad, sample) if 0 <= sample - k <= bad else 0 for k in range(good + 1)]
        assert np.abs(got - want).max() < 0.02
    big = hypergeometric(rng, np.full(4000, 3 * 10**12), 10**12, 10**10)
    assert abs(big.mean() / 7.5e9 - 1) < 1e-5
    assert abs(big.std() / math.sqrt(10**10 * 0.75 * 0.25 * (1 - 10**10 / (4 * 10**12))) - 1) < 0.05
    left = np.tile([5, 0, 9, 2], (500, 1))
    out = dealt(rng, left, np.full(500, 7))
    assert (out.sum(1) == 7).all() and (out >= 0).all() and (out <= left).all()


@pytest.mark.parametrize("size", [10, 10**3, 10**6, 10**10, 10**14])
def test_draw_weights_against_exact_fractions(size):
    import numpy as np
    from fractions import Fraction

    from cohortspark.functions.draws import log_weight

    for share, taken in ((Fraction(1, 2), Fraction(1, 3)), (Fraction(9, 10), Fraction(1, 1000)), (Fraction(1, 7), Fraction(9, 10))):
        good, sample = max(int(size * share), 1), max(int(size * taken), 1)
        bad = size - good
        low, high = max(0, sample - bad), min(sample, good)
        begin = min(max(int(Fraction(sample * good, size)) - 40, low), high)
        ks = list(range(begin, min(begin + 80, high) + 1))
        weight = log_weight(np.array(ks), *(np.array([x]) for x in (good, bad, sample)))
        exact = Fraction(1)
        for i, k in enumerate(ks[1:], 1):
            # the ratio of neighbours has a closed form
            exact *= Fraction((good - k + 1) * (sample - k + 1), k * (bad - sample + k))
            assert weight[i] - weight[0] == pytest.approx(math.log(exact), abs=1e-8, rel=1e-7)
    # far from the mode as well, where a log factorial of this size would have no digit left
    good, bad, sample, step = 10**14, 10**14, 10**13, 10**4
    mode = 5 * 10**12
    got = log_weight(np.array([mode, mode + step]), *(np.array([x]) for x in (good, bad, sample)))
    want = math.fsum(
        math.log1p(float(Fraction((good - k + 1) * (sample - k + 1) - k * (bad - sample + k), k * (bad - sample + k))))
        for k in range(mode + 1, mode + step + 1)
    )
    assert got[1] - got[0] == pytest.approx(want, rel=1e-5, abs=1e-9)


def test_monte_carlo_in_blocks_of_levels(spark, monkeypatch):
    cells = spark.createDataFrame(
        [("c", f"l{i}", g, 10 + (i * k) % 7) for i in range(40) for k, g in ((1, "A"), (2, "B"), (3, "C"))],
        "var string, val string, grp string, o long",
    )
    whole = cm.chi_square_p(cells).first()["p_value"]
    monkeypatch.setattr(cm, "_BLOCK_LEVELS", 4)
    assert abs(cm.chi_square_p(cells).first()["p_value"] - whole) < 0.06


def test_ranges_split_what_lies_close_together(spark):
    from cohortspark.operators.ranks import _in_ranges, exact_quantiles, running_totals

    df = spark.range(200_000).select(F.lit("g").alias("g"), (F.col("id") + 1_700_000_000).cast("double").alias("v"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in _in_ranges(df, ["g"], "v").groupBy("_bucket").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 3 * 200_000 / 8
        got = exact_quantiles(df, "v", {"a": 0.25, "b": 0.5}, ["g"]).first()
        assert (got["a"], got["b"]) == (1_700_000_000 + 199_999 * 0.25, 1_700_000_000 + 199_999 * 0.5)
        last = running_totals(df, "v", ["n"], ["g"], descending=False).orderBy(F.desc("v")).first()
        assert (last["n_cum"], last["n_total"]) == (200_000, 200_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
