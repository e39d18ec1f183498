"""Quality of predictions: threshold sweep, ROC and PR areas, operating points, calibration.

All measures start from one row per distinct score with its number of cases and
positives, and from running totals over these rows. No pair of cases is formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators.ranks import exact_quantiles, running_totals
from cohortspark.sources.tables import stack

Z_95 = 1.959963984540054

# measures of the sweep averaged over all cutoffs, and the name of the average
MEANS = {
    "prec": "prec_m", "rec_sens": "sens_m", "spec": "spec_m", "ppv": "ppv_m", "npv": "npv_m",
    "acc": "acc_m", "fscore": "fscore_m", "mcc": "mcc_m",
}


def score_counts(predictions: DataFrame, pred: str = "pred", real: str = "real") -> DataFrame:
    """One row per distinct score, from the highest down, with cumulative counts.

    ``n`` cases and ``p`` positives have the score, ``n_cum`` and ``p_cum`` have
    it or a higher one, ``n_total`` and ``p_total`` are all there are.
    """
    counts = (
        predictions.where(F.col(pred).isNotNull() & F.col(real).isNotNull())
        .groupBy(F.col(pred).cast("double").alias("score"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(real).cast("long")).alias("p"))
    )
    return running_totals(counts, "score", ["n", "p"])


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def threshold_sweep(counts: DataFrame) -> DataFrame:
    """Every score as a cutoff: positive is what scores at least as much.

    Cutoffs without precision, recall or specificity are left out.
    """
    base = counts.select(
        F.col("score").alias("cutoff"),
        _d("p_cum").alias("tp"),
        (_d("n_cum") - _d("p_cum")).alias("fp"),
        (_d("p_total") - _d("p_cum")).alias("fn"),
        (_d("n_total") - _d("n_cum") - _d("p_total") + _d("p_cum")).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec, rec = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    spec, npv = F.try_divide(tn, tn + fp), F.try_divide(tn, tn + fn)
    fscore = F.try_divide(2 * prec * rec, prec + rec)
    mcc = F.try_divide(
        tp * tn - fp * fn, F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    )
    return base.select(
        "cutoff",
        prec.alias("prec"),
        rec.alias("rec_sens"),
        prec.alias("ppv"),
        npv.alias("npv"),
        F.abs(prec - rec).alias("prec_rec_dist"),
        fscore.alias("fscore"),
        spec.alias("spec"),
        F.sqrt(F.pow(1 - rec, 2) + F.pow(1 - spec, 2)).alias("euclid_meas"),
        (rec + spec - 1).alias("youden_meas"),
        F.try_divide(fp, tp + fp).alias("pcfall"),
        ((tp + tn) / (tp + tn + fp + fn)).alias("acc"),
        mcc.alias("mcc"),
        # cutoffs are distinct, so each stands for one row
        F.lit(1).cast("long").alias("size"),
    ).where("prec > 0 AND rec_sens > 0 AND spec > 0")


def operating_point(sweep: DataFrame) -> DataFrame:
    """One row: the cutoff closest to the perfect corner, and the one where precision meets recall.

    The lowest cutoff wins a tie.
    """
    corner = F.min(F.struct("euclid_meas", "cutoff", "rec_sens", "spec", "ppv", "npv"))
    balance = F.min(F.struct("prec_rec_dist", "cutoff", "prec", "rec_sens", "fscore"))
    return sweep.agg(corner.alias("c"), balance.alias("b")).select(
        F.col("c.cutoff").alias("opt_thresh"),
        F.col("c.rec_sens").alias("opt_sens"),
        F.col("c.spec").alias("opt_spec"),
        F.col("c.ppv").alias("opt_ppv"),
        F.col("c.npv").alias("opt_npv"),
        F.col("b.prec").alias("opt_prec"),
        F.col("b.rec_sens").alias("opt_rec"),
        F.col("b.fscore").alias("opt_fscore"),
    )


def roc_auc_ci(counts: DataFrame, z: float = Z_95) -> DataFrame:
    """One row: the area under the ROC curve and its confidence limits.

    The variance is DeLong's, from the placement of each case among the controls
    and of each control among the cases. Where controls score higher than cases
    by median, the direction is turned.
    """
    pos, neg = _d("p_total"), _d("n_total") - _d("p_total")
    q = _d("n") - _d("p")
    below = neg - (_d("n_cum") - _d("p_cum"))
    above = _d("p_cum") - _d("p")
    placed = counts.select(
        _d("p").alias("p"),
        q.alias("q"),
        pos.alias("pos"),
        neg.alias("neg"),
        F.try_divide(below + q / 2, neg).alias("v10"),
        F.try_divide(above + _d("p") / 2, pos).alias("v01"),
        "score",
        (pos - _d("p_cum")).alias("p_start"),
        below.alias("q_start"),
    )

    def middle(weight: str, start: str, total: str) -> Column:
        """Median of the scores of one class, from where its ranks start."""
        def at(rank: Column) -> Column:
            held = (rank >= F.col(start)) & (rank < F.col(start) + F.col(weight))
            return F.max(F.when(held, F.col("score")))

        half = (F.col(total) - 1) / 2
        return (at(F.floor(half)) + at(F.ceil(half))) / 2

    def spread(value: str, weight: str) -> Column:
        return F.try_divide(
            F.sum(F.col(weight) * F.col(value) * F.col(value))
            - F.try_divide(F.pow(F.sum(F.col(weight) * F.col(value)), 2), F.sum(weight)),
            F.sum(weight) - 1,
        )

    sums = placed.agg(
        F.try_divide(F.sum(F.col("p") * F.col("v10")), F.sum("p")).alias("auc"),
        F.try_divide(spread("v10", "p"), F.sum("p")).alias("s10"),
        F.try_divide(spread("v01", "q"), F.sum("q")).alias("s01"),
        middle("p", "p_start", "pos").alias("case_median"),
        middle("q", "q_start", "neg").alias("control_median"),
    )
    turned = F.col("control_median") > F.col("case_median")
    error = F.sqrt(F.greatest(F.col("s10") + F.col("s01"), F.lit(0.0)))
    auc = F.when(turned, 1 - F.col("auc")).otherwise(F.col("auc"))
    low = F.when(error.isNotNull() & auc.isNotNull(), F.greatest(auc - z * error, F.lit(0.0)))
    up = F.when(error.isNotNull() & auc.isNotNull(), F.least(auc + z * error, F.lit(1.0)))
    return sums.select(low.alias("roauc_low"), auc.alias("roauc"), up.alias("roauc_up"))


# unit steps summed one by one before the rest is summed in closed form
_STEPS = 32


def pr_auc(counts: DataFrame) -> DataFrame:
    """One row: area under the precision-recall curve, by integral and by unit steps.

    Between two cutoffs the false positives grow in proportion to the true ones,
    so precision at x true positives is x / (a x + b). ``prauc1`` integrates it.
    ``prauc2`` joins its values at every whole x by straight lines, as Davis and
    Goadrich do; past the first steps that sum is taken by the Euler-Maclaurin
    formula, so its cost does not grow with the number of positives.
    """
    seg = counts.where("p > 0").select(
        _d("p").alias("p"),
        _d("p_total").alias("pos"),
        (_d("p_cum") - _d("p")).alias("x0"),
        _d("p_cum").alias("x1"),
        (_d("n_cum") - _d("p_cum") - _d("n") + _d("p")).alias("f0"),
        ((_d("n") - _d("p")) / _d("p")).alias("h"),
    )
    seg = seg.withColumn("a", 1 + F.col("h")).withColumn("b", F.col("f0") - F.col("h") * F.col("x0"))
    a, b, x0, x1 = (F.col(c) for c in ("a", "b", "x0", "x1"))
    flat = F.abs(b) < 1e-9 * (1 + F.col("f0"))

    def u(x: Column) -> Column:
        return a * x + b

    def height(x: Column) -> Column:
        return F.try_divide(x, u(x))

    def integral(lo: Column, hi: Column) -> Column:
        return (hi - lo) / a - b / (a * a) * F.ln(F.try_divide(u(hi), u(lo)))

    def ends(order: int, lo: Column, hi: Column) -> Column:
        """Difference of an odd derivative of the precision between both ends."""
        factor = {1: 1.0, 3: 6.0, 5: 120.0}[order]

        def at(x: Column) -> Column:
            return F.try_divide(factor * b * F.pow(a, F.lit(float(order - 1))), F.pow(u(x), F.lit(order + 1.0)))

        return at(hi) - at(lo)

    steps = F.least(F.col("p"), F.lit(float(_STEPS)))
    split = x0 + steps
    first = F.aggregate(
        F.sequence(F.lit(0), steps.cast("int") - 1),
        F.lit(0.0),
        lambda total, i: total + (height(x0 + i) + height(x0 + i + 1)) / 2,
    )
    rest = F.when(split >= x1, F.lit(0.0)).otherwise(
        integral(split, x1)
        + ends(1, split, x1) / 12
        - ends(3, split, x1) / 720
        + ends(5, split, x1) / 30240
    )
    pieces = seg.select(
        "pos",
        F.when(flat, F.col("p") / a).otherwise(integral(x0, x1)).alias("smooth"),
        F.when(flat, F.col("p") / a).otherwise(first + rest).alias("stepped"),
    )
    return pieces.agg(
        F.try_divide(F.sum("smooth"), F.max("pos")).alias("prauc1"),
        F.try_divide(F.sum("stepped"), F.max("pos")).alias("prauc2"),
    )


def cutoff_means(sweep: DataFrame) -> DataFrame:
    """One row: the mean of each measure over all cutoffs."""
    return sweep.agg(*(F.avg(c).alias(name) for c, name in MEANS.items()))


def perf_summary(predictions: DataFrame, pred: str = "pred", real: str = "real") -> DataFrame:
    """All summary measures in long form: ``overall_meas`` and ``meas_val``."""
    counts = score_counts(predictions, pred, real)
    sweep = threshold_sweep(counts)
    wide = [roc_auc_ci(counts), operating_point(sweep), pr_auc(counts), cutoff_means(sweep)]
    return stack([w.unpivot([], w.columns, "overall_meas", "meas_val") for w in wide])


def calibration(
    predictions: DataFrame, pred: str = "pred", real: str = "real", n_bin: int = 20
) -> DataFrame:
    """Observed against predicted rate per quantile bin of the predictions.

    Bins are closed on the right, the first one on both sides; equal breaks are
    merged. The 95 % limits lie around the mean prediction.
    """
    cases = predictions.select(F.col(pred).cast("double").alias("pred"), F.col(real).cast("long").alias("y")).where(
        "pred IS NOT NULL AND y IS NOT NULL"
    )
    probs = {f"q{i}": i / n_bin for i in range(n_bin + 1)}
    breaks = exact_quantiles(cases, "pred", probs).select(F.array_distinct(F.array(*probs))).scalar()
    below = F.size(F.filter("_breaks", lambda edge: edge < F.col("pred")))
    binned = (
        cases.withColumn("_breaks", breaks)
        .withColumn("pred_bin", F.greatest(below, F.lit(1)))
        .drop("_breaks")
    )
    sums = binned.groupBy("pred_bin").agg(
        F.count(F.lit(1)).alias("expos"),
        F.min("pred").alias("bin_lower"),
        F.max("pred").alias("bin_upper"),
        F.sum("y").alias("y_agg"),
        F.avg("pred").alias("pred_p"),
    )
    middles = exact_quantiles(binned, "pred", {"bin_mid": 0.5}, ["pred_bin"])
    rate = F.col("y_agg") / F.col("expos")
    half = 1.96 * F.sqrt(F.col("y_p") * (1 - F.col("y_p")) / F.col("expos"))
    return (
        sums.join(middles, "pred_bin")
        .withColumn("y_p", rate)
        .withColumn("binci_lower", F.greatest(F.lit(0.0), F.col("pred_p") - half))
        .withColumn("binci_upper", F.col("pred_p") + half)
    )
