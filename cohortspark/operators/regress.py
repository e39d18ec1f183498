"""Generalised linear models and their coefficient tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import RFormula
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Fit(NamedTuple):
    """A fitted model with its terms in the order of the coefficients."""

    model: PipelineModel
    terms: list[str]
    coefficients: DataFrame
    goodness: DataFrame


def _feature_names(df: DataFrame) -> list[str]:
    groups = df.schema["features"].metadata["ml_attr"]["attrs"]
    attrs = [a for group in groups.values() for a in group]
    return [a["name"] for a in sorted(attrs, key=lambda a: a["idx"])]


def fit_glm(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    family: str = "binomial",
    categorical: Sequence[str] = (),
    max_iter: int = 50,
) -> Fit:
    """Fit ``label`` on ``features``; rows with a missing value are left out.

    Categorical features are dummy-coded against their alphabetically first
    level, the others enter as numbers.
    """
    columns = [F.col(label).cast("double").alias(label)]
    columns += [F.col(c).cast("string" if c in categorical else "double").alias(c) for c in features]
    rows = df.select(*columns).dropna()
    formula = RFormula(
        formula=f"{label} ~ {' + '.join(features)}",
        stringIndexerOrderType="alphabetDesc",
        featuresCol="features",
        labelCol="label",
    )
    regression = GeneralizedLinearRegression(
        family=family, featuresCol="features", labelCol="label", predictionCol="prediction",
        maxIter=max_iter, tol=1e-10,
    )
    # each iteration reads the rows again
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=[formula, regression]).fit(rows)
        summary = model.stages[-1].summary
        names = _feature_names(model.stages[0].transform(rows))
        spark = df.sparkSession
        terms = [*names, "(Intercept)"]
        estimates = [*map(float, model.stages[-1].coefficients), float(model.stages[-1].intercept)]
        table = list(
            zip(
                terms,
                estimates,
                map(float, summary.coefficientStandardErrors),
                map(float, summary.tValues),
                map(float, summary.pValues),
            )
        )
        coefficients = spark.createDataFrame(
            table, "term string, estimate double, std_error double, statistic double, p_value double"
        )
        goodness = spark.createDataFrame(
            [
                (
                    float(summary.nullDeviance), float(summary.deviance), float(summary.aic),
                    float(summary.dispersion), int(summary.degreesOfFreedom),
                    int(summary.residualDegreeOfFreedom),
                )
            ],
            "null_deviance double, deviance double, aic double, dispersion double,"
            " df_model long, df_residual long",
        )
    finally:
        rows.unpersist()
    return Fit(model, terms, coefficients, goodness)


def fitted(fit: Fit, df: DataFrame, label: str, real: str | None = None) -> DataFrame:
    """Predictions as ``pred`` beside the outcome as ``real``, ready for the evaluation.

    ``real`` is an SQL condition on the label, such as ``"label >= 96"``, for
    outcomes that are not 0 or 1.
    """
    needed = fit.model.stages[0].getFormula().split("~")[1].split("+")
    rows = df.select(F.col(label).cast("double").alias(label), *(F.col(c.strip()) for c in needed)).dropna()
    outcome = F.expr(real) if real else F.col(label)
    return fit.model.transform(rows).select(
        F.col("prediction").alias("pred"), outcome.cast("int").alias("real")
    )
