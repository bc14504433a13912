"""Probability calibration: fitted on one half, chosen and reported on the other."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import sigmoid
from riskloom.operators.folds import stratified_split
from riskloom.operators.metrics import brier_expr

METHODS = ("sigmoid", "isotonic")
KNOT_DIGITS = 6


@dataclass(frozen=True)
class SigmoidCalibrator:
    """1 / (1 + exp(-(slope * p + intercept)))"""

    slope: float
    intercept: float
    method: str = "sigmoid"

    def column(self, score: Column) -> Column:
        return sigmoid(score * self.slope + self.intercept)

    def transform(self, df: DataFrame, score: str, out: str) -> DataFrame:
        return df.withColumn(out, self.column(F.col(score)))


@dataclass(frozen=True)
class IsotonicCalibrator:
    """Monotone steps with linear interpolation, flat outside the fitted range."""

    model: IsotonicRegressionModel
    method: str = "isotonic"

    def transform(self, df: DataFrame, score: str, out: str) -> DataFrame:
        model = self.model.copy().setFeaturesCol(score).setPredictionCol("_iso")
        clipped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_iso")))
        return model.transform(df).withColumn(out, clipped).drop("_iso")


Calibrator = SigmoidCalibrator | IsotonicCalibrator


def fit_sigmoid(
    df: DataFrame, score: str = "p", label: str = "label", penalty: float = 0.0
) -> SigmoidCalibrator:
    """Logistic regression on the score alone."""
    rows = df.select(F.col(label).cast("double").alias("label"), F.col(score).alias("_p"))
    vectors = VectorAssembler(inputCols=["_p"], outputCol="features").transform(rows)
    model = LogisticRegression(
        regParam=penalty, standardization=False, maxIter=200, tol=1e-10
    ).fit(vectors)
    return SigmoidCalibrator(float(model.coefficients[0]), float(model.intercept))


def fit_isotonic(
    df: DataFrame, score: str = "p", label: str = "label", digits: int = KNOT_DIGITS
) -> IsotonicCalibrator:
    """Isotonic regression on scores grouped onto a grid of ``digits`` decimals.

    Spark merges the knots on the driver; grouping first bounds them by the grid
    (10**digits + 1) whatever the number of rows.
    """
    scale = float(10**digits)
    grouped = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy((F.floor(F.col(score) * scale + 0.5) / scale).alias("features"))
        .agg(
            F.avg(F.col(label).cast("double")).alias("label"),
            F.count(F.lit(1)).cast("double").alias("weight"),
        )
    )
    model = IsotonicRegression(
        featuresCol="features", labelCol="label", weightCol="weight", isotonic=True
    ).fit(grouped)
    return IsotonicCalibrator(model)


def fit_calibrator(df: DataFrame, method: str, score: str = "p", label: str = "label") -> Calibrator:
    if method == "sigmoid":
        return fit_sigmoid(df, score, label)
    if method == "isotonic":
        return fit_isotonic(df, score, label)
    raise ValueError(f"Unknown calibration method: {method}")


@dataclass
class CalibrationResult:
    calibrators: dict[str, Calibrator]
    best: str
    brier: dict[str, float]
    evaluated: DataFrame

    @property
    def best_calibrator(self) -> Calibrator:
        return self.calibrators[self.best]

    def brier_table(self) -> DataFrame:
        rows = [(m, b, m == self.best) for m, b in self.brier.items()]
        return self.evaluated.sparkSession.createDataFrame(
            rows, "method string, brier double, is_best boolean"
        )


def calibrate_with_split(
    df: DataFrame,
    key: str,
    score: str = "p",
    label: str = "label",
    test_share: float = 0.5,
    methods: Sequence[str] = METHODS,
    seed: int = 42,
) -> CalibrationResult:
    """Fit each method on one half; the lower Brier score on the other half wins, the
    earlier method on a tie. ``evaluated`` holds that half with ``calibrated``."""
    parts = stratified_split(df, key, label, test_share, seed)
    fit, held = parts.where(~F.col("is_eval")), parts.where("is_eval").drop("is_eval")
    fitted = {m: fit_calibrator(fit, m, score, label) for m in methods}
    scored = held
    for m, calibrator in fitted.items():
        scored = calibrator.transform(scored, score, f"_cal_{m}")
    row = scored.agg(*[brier_expr(label, f"_cal_{m}").alias(m) for m in methods]).first()
    assert row is not None
    brier = {m: float(row[m]) for m in methods}
    best = min(methods, key=lambda m: brier[m])
    evaluated = scored.withColumn("calibrated", F.col(f"_cal_{best}"))
    return CalibrationResult(
        fitted, best, brier, evaluated.drop(*[f"_cal_{m}" for m in methods])
    )
