"""Stacking as a fitted object: scaler, one logistic meta-model per fold, new-row scores.

A fitted stack is a few numbers per input, so scoring is a plain expression inside the
row: no join, no shuffle, and the same code serves batch tables and streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import total
from riskloom.plans.lineage import checkpointed

# Fixed value: inverse strength of the meta-model's penalty.
C = 1.0


def _scaled(name: str, mean: float, scale: float) -> Column:
    # an input without spread says nothing
    return (F.col(name).cast("double") - mean) / scale if scale > 0 else F.lit(0.0)


def _known(inputs: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in inputs])


@dataclass
class StackModel:
    """``weights[k]`` are fold k's intercept and coefficients of the scaled inputs."""

    inputs: list[str]
    means: list[float]
    scales: list[float]
    weights: list[list[float]]

    def fold_score(self, k: int) -> Column:
        """Score by the model that did not see fold k."""
        bias, *slopes = self.weights[k]
        parts = zip(slopes, self.inputs, self.means, self.scales, strict=True)
        margin = total([F.lit(bias), *[_scaled(c, m, s) * w for w, c, m, s in parts]])
        return F.when(_known(self.inputs), 1.0 / (1.0 + F.exp(-margin)))

    def score(self) -> Column:
        """Mean over the fold models; NULL where an input is missing."""
        return total([self.fold_score(k) for k in range(len(self.weights))]) / len(self.weights)

    def transform(self, df: DataFrame, name: str = "p") -> DataFrame:
        return df.withColumn(name, self.score())

    def out_of_fold(self, df: DataFrame, fold: str = "fold", name: str = "p") -> DataFrame:
        """Every row scored by the model of its own fold; NULL without a known fold."""
        choice = F.lit(None).cast("double")
        for k in range(len(self.weights)):
            choice = F.when(F.col(fold) == k, self.fold_score(k)).otherwise(choice)
        return df.withColumn(name, choice)

    def save(self, spark: SparkSession, path: str) -> None:
        row = (self.inputs, self.means, self.scales, self.weights)
        schema = "inputs array<string>, means array<double>, scales array<double>, weights array<array<double>>"
        spark.createDataFrame([row], schema).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StackModel:
        row = spark.read.parquet(path).first()
        if row is None:
            raise ValueError(f"no stack in {path}")
        return cls(list(row["inputs"]), list(row["means"]), list(row["scales"]), [list(w) for w in row["weights"]])


def fit_stack(
    df: DataFrame,
    scores: Sequence[str],
    folds: int,
    label: str = "label",
    fold: str = "fold",
    c: float = C,
    extra: Sequence[str] = (),
) -> StackModel:
    """Fit the scaler on all known rows and one meta-model per fold on the other folds.

    ``extra`` adds original features to the inputs. Rows with a missing label or input
    do not train; a training part without both classes raises.
    """
    inputs = [*scores, *extra]
    known = df.where(_known(inputs) & F.col(label).isNotNull() & F.col(fold).isNotNull()).select(
        F.col(label).cast("double").alias("label"),
        F.col(fold).alias("fold"),
        *[F.col(i).cast("double").alias(i) for i in inputs],
    )
    moments = known.agg(
        *[F.avg(i).alias(f"m{j}") for j, i in enumerate(inputs)],
        *[F.stddev_samp(i).alias(f"s{j}") for j, i in enumerate(inputs)],
    ).first()
    assert moments is not None
    means = [float(moments[f"m{j}"] or 0.0) for j in range(len(inputs))]
    scales = [float(moments[f"s{j}"] or 0.0) for j in range(len(inputs))]
    scaled = known.select(
        "label", "fold", *[_scaled(i, m, s).alias(i) for i, m, s in zip(inputs, means, scales, strict=True)]
    )
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(scaled)
    rows = checkpointed(vectors.select("label", "fold", "features"))
    sizes = {
        r["fold"]: (r["n"], r["s"])
        for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("s")).collect()
    }
    weights = []
    for k in range(folds):
        n = sum(v[0] for f, v in sizes.items() if f != k)
        positive = sum(v[1] for f, v in sizes.items() if f != k)
        if not 0 < positive < n:
            raise ValueError(f"the training part of fold {k} has {positive:.0f} positives in {n} rows")
        # penalty of 1/(2C) on the summed loss is 1/(C n) on Spark's mean loss
        learner = LogisticRegression(
            regParam=1.0 / (c * n), standardization=False, maxIter=500, tol=1e-12
        )
        model = learner.fit(rows.where(F.col("fold") != k))
        weights.append([float(model.intercept), *map(float, model.coefficients)])
    return StackModel(inputs, means, scales, weights)
