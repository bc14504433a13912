"""Cross-validated Spark ML learners and what is read off them.

The loops over folds and seeds run on the driver, several at a time where asked for; every fit, transform and metric is a distributed
job over a feature table frozen once on shared storage.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import total
from riskloom.operators import metrics
from riskloom.operators.selection import importance_cutoff
from riskloom.plans.concurrent import concurrently
from riskloom.plans.lineage import checkpointed

# Missing inputs of the trees, elimination limits.
FILL_VALUE = -999.0
ELIMINATION_TOLERANCE = 0.0003
ELIMINATION_MIN_FEATURES = 50
ELIMINATION_PERCENTILE = 10.0
ELIMINATION_ROUNDS = 5


@dataclass(frozen=True)
class BoostParams:
    """Boosted-tree settings.

    Spark's trees have no leaf count and stop on a tolerance, so 31 leaves become
    depth 5 and the patience of early stopping a small ``tolerance``.
    """

    max_iter: int = 200
    step_size: float = 0.05
    max_depth: int = 5
    min_rows: int = 20
    row_share: float = 0.8
    feature_share: float = 0.8
    positive_weight: float = 2.15
    tolerance: float = 1e-5
    max_bins: int = 64
    seed: int = 42


LEARNER_A = BoostParams()
LEARNER_B = BoostParams(max_depth=6, min_rows=5, positive_weight=2.5)


def boosted(params: BoostParams = LEARNER_A) -> Callable[[], Estimator]:
    """Factory of a boosted-tree estimator reading the prepared columns."""

    def build() -> Estimator:
        return GBTClassifier(
            featuresCol="features",
            labelCol="label",
            weightCol="_weight",
            validationIndicatorCol="_validation",
            maxIter=params.max_iter,
            stepSize=params.step_size,
            maxDepth=params.max_depth,
            minInstancesPerNode=params.min_rows,
            subsamplingRate=params.row_share,
            featureSubsetStrategy=str(params.feature_share),
            validationTol=params.tolerance,
            maxBins=params.max_bins,
            seed=params.seed,
        )

    return build


def forest(
    trees: int = 100, max_depth: int = 8, min_rows: int = 20, seed: int = 42
) -> Callable[[], Estimator]:
    """Factory of the third learner, a random forest over encoded categories.

    A row's node in every tree is kept between the levels, so that no level walks all
    trees from their roots again; the trees are the same without.
    """

    def build() -> Estimator:
        return RandomForestClassifier(
            featuresCol="features",
            labelCol="label",
            weightCol="_weight",
            numTrees=trees,
            maxDepth=max_depth,
            minInstancesPerNode=min_rows,
            cacheNodeIds=True,
            seed=seed,
        )

    return build


def filled_sql(column: str) -> str:
    """A feature as the trees see it: Spark's trees reject NaN, so a missing value
    becomes -999, below every real one."""
    return f"coalesce(CAST(`{column}` AS DOUBLE), {FILL_VALUE}D) AS `{column}`"


def prepare(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    label: str,
    fold: str = "fold",
    positive_weight: float = 1.0,
    extra: Sequence[str] = (),
) -> DataFrame:
    """(key, label, fold, _weight, features) with missing inputs filled, frozen."""
    filled = df.selectExpr(
        f"`{key}`",
        f"CAST(`{label}` AS DOUBLE) AS label",
        f"`{fold}` AS fold",
        *extra,
        *[filled_sql(c) for c in features],
    ).where("label IS NOT NULL")
    weight = F.when(F.col("label") == 1, F.lit(positive_weight)).otherwise(F.lit(1.0))
    vectors = VectorAssembler(inputCols=list(features), outputCol="features")
    rows = vectors.transform(filled).withColumn("_weight", weight)
    return checkpointed(rows.select(key, "label", "fold", *extra, "_weight", "features"))


def probability() -> Column:
    return F.get(vector_to_array("probability"), F.lit(1))


@dataclass
class CvResult:
    """``chosen`` holds the input columns of each fold's model."""

    chosen: list[list[str]]
    models: list[Model]
    oof: DataFrame

    def fold_metrics(self) -> DataFrame:
        return metrics.auc(self.oof, score="p", keys=["fold"])

    def summary(self) -> DataFrame:
        """One row: AUC over all out-of-fold rows, mean and spread over folds."""
        folds = self.fold_metrics().agg(
            F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc")
        )
        overall = metrics.auc(self.oof, score="p").select(F.col("auc").alias("oof_auc"))
        return overall.withColumns(
            {
                "mean_auc": folds.select("mean_auc").scalar(),
                "std_auc": folds.select("std_auc").scalar(),
            }
        )

    def scores(self) -> tuple[float, float, float]:
        row = self.summary().first()
        assert row is not None
        return float(row["oof_auc"]), float(row["mean_auc"]), float(row["std_auc"])


def sliced(df: DataFrame, features: Sequence[str], chosen: Sequence[str]) -> DataFrame:
    """``features`` reduced to the chosen entries of the full vector."""
    if list(chosen) == list(features):
        return df
    at = {c: i for i, c in enumerate(features)}
    slicer = VectorSlicer(
        inputCol="_full", outputCol="features", indices=[at[c] for c in chosen]
    )
    return slicer.transform(df.withColumnRenamed("features", "_full")).drop("_full")


def run_cv(
    prepared: DataFrame,
    features: Sequence[str],
    key: str,
    build: Callable[[], Estimator],
    folds: int,
    chosen: Sequence[Sequence[str]] | None = None,
    parallel: int = 1,
) -> CvResult:
    """Fit one model per fold on the other folds; score each row by the model that
    did not see it. The held-out fold also drives early stopping. ``chosen`` gives each
    fold its own subset of the features. ``parallel`` folds are fitted at a time, with the
    same results."""
    picks = [list(c) for c in chosen] if chosen is not None else [list(features)] * folds

    def fitted(k: int) -> Model:
        estimator = build()
        rows = sliced(prepared, features, picks[k])
        held_out = F.col("fold") == k
        if estimator.hasParam("validationIndicatorCol"):
            return estimator.fit(rows.withColumn("_validation", held_out))
        return estimator.fit(rows.where(~held_out))

    models = concurrently(prepared.sparkSession, [partial(fitted, k) for k in range(folds)], parallel)
    oof = None
    for k, model in enumerate(models):
        scored = model.transform(sliced(prepared, features, picks[k]).where(F.col("fold") == k))
        part = scored.select(key, "fold", "label", probability().alias("p"))
        oof = part if oof is None else oof.unionByName(part)
    assert oof is not None
    return CvResult(picks, models, checkpointed(oof))


def averaged(scores: Sequence[Column]) -> Column:
    """The mean, added in the order given, so that equal runs give equal bits."""
    return total(list(scores)) / float(len(scores))


@dataclass
class SeedRuns:
    """Cross-validated runs that differ by their seed; results in the order of ``seeds``."""

    seeds: list[int]
    results: list[CvResult]
    features: list[str]
    key: str

    def log(self) -> DataFrame:
        """(step, seed, oof_auc, mean_auc, std_auc), a row per run."""
        rows = [
            result.summary().select(F.lit(i).alias("step"), F.lit(seed).alias("seed"), "oof_auc", "mean_auc", "std_auc")
            for i, (seed, result) in enumerate(zip(self.seeds, self.results, strict=True))
        ]
        return reduce(DataFrame.unionByName, rows)

    def oof(self) -> DataFrame:
        """(key, fold, label, p): the mean over the seeds of each row's out-of-fold scores."""
        scores = [
            r.oof.select(self.key, F.struct(F.lit(i).alias("i"), "p").alias("s"), "fold", "label")
            for i, r in enumerate(self.results)
        ]
        # a row per seed of a key
        inner = F.sort_array(F.collect_list("s"))
        p = averaged([F.get(inner, F.lit(i))["p"] for i in range(len(self.seeds))])
        return reduce(DataFrame.unionByName, scores).groupBy(self.key, "fold", "label").agg(p.alias("p"))

    def score(self, prepared: DataFrame) -> DataFrame:
        """(key, p): the mean over all seeds and folds for rows no model has seen, in one scan."""
        rows, columns = prepared, []
        for i, result in enumerate(self.results):
            for k, model in enumerate(result.models):
                out, inputs = f"_p_{i}_{k}", f"_x_{i}_{k}"
                at = [self.features.index(c) for c in result.chosen[k]]
                rows = VectorSlicer(inputCol="features", outputCol=inputs, indices=at).transform(rows)
                quiet = model.copy().setProbabilityCol(out).setFeaturesCol(inputs)
                rows = quiet.setRawPredictionCol("").setPredictionCol("").transform(rows).drop(inputs)
                columns.append(F.get(vector_to_array(out), F.lit(1)))
        return rows.select(self.key, averaged(columns).alias("p"))


def folds_at_once(prepared: DataFrame, folds: int, parallel: int) -> int:
    """Folds that each of ``parallel`` runs fits side by side so that there are two tasks a core.

    A fit has as many tasks as ``prepared`` has partitions, and those are few in a table of
    moderate size; a large one fills the cluster by itself and its folds go one by one, as
    every fit keeps its training rows on the executors.
    """
    tasks = max(1, parallel * prepared.rdd.getNumPartitions())
    wanted = 2 * prepared.sparkSession.sparkContext.defaultParallelism
    return max(1, min(folds, math.ceil(wanted / tasks)))


def run_seeds(
    prepared: DataFrame,
    features: Sequence[str],
    key: str,
    build: Callable[[int], Callable[[], Estimator]],
    folds: int,
    seeds: Sequence[int],
    chosen: Sequence[Sequence[str]] | None = None,
    parallel: int = 2,
) -> SeedRuns:
    """:func:`run_cv` once per seed over the same prepared rows, ``parallel`` seeds at a time
    and their folds by :func:`folds_at_once`.

    ``build(seed)`` is the factory of that seed's learner. What is kept on the driver are
    the fitted models.
    """
    if len(set(seeds)) != len(seeds) or not seeds:
        raise ValueError(f"Seeds must be distinct and at least one: {list(seeds)}")
    side = folds_at_once(prepared, folds, min(parallel, len(seeds))) if parallel > 1 else 1
    tasks = [partial(run_cv, prepared, features, key, build(seed), folds, chosen, side) for seed in seeds]
    results = concurrently(prepared.sparkSession, tasks, parallel)
    return SeedRuns(list(seeds), results, list(features), key)


def mean_scores(parts: Sequence[DataFrame], key: str, score: str = "p") -> DataFrame:
    """Mean score per key over the outputs of several models or seeds."""
    out = parts[0].select(key, score)
    for part in parts[1:]:
        out = out.unionByName(part.select(key, score))
    return out.groupBy(key).agg(F.avg(score).alias(score))


def fold_importances(result: CvResult) -> DataFrame:
    """(fold, feature, importance) of fitted tree models, read from the models."""
    spark = result.oof.sparkSession
    rows = [
        (k, name, float(value))
        for k, model in enumerate(result.models)
        for name, value in zip(
            result.chosen[k], model.featureImportances.toArray(), strict=True
        )
    ]
    return spark.createDataFrame(rows, "fold int, feature string, importance double")


def mean_importance(per_fold: DataFrame, top: int | None = None) -> DataFrame:
    out = (
        per_fold.groupBy("feature")
        .agg(F.avg("importance").alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )
    return out.limit(top) if top is not None else out


def log_with_delta(log: DataFrame, step: str = "step", score: str = "oof_auc") -> DataFrame:
    """Experiment log with the change against the previous row; the first has none."""
    # a log has one row per experiment, so one window partition is enough
    order = Window.partitionBy(F.lit(0)).orderBy(step)
    before = F.lag(score).over(order)
    return log.withColumn("delta", F.coalesce(F.col(score) - before, F.lit(0.0)))


# -- experiments ------------------------------------------------------------------


def ablation(
    df: DataFrame,
    groups: Sequence[tuple[str, Sequence[str]]],
    key: str,
    label: str,
    build: Callable[[], Estimator],
    folds: int,
    fold: str = "fold",
) -> DataFrame:
    """Add one feature group after another and log the out-of-fold AUC."""
    active: list[str] = []
    rows = []
    for step, (name, columns) in enumerate(groups):
        new = [c for c in columns if c in df.columns and c not in active]
        active = active + new
        prepared = prepare(df, active, key, label, fold)
        oof, _, std = run_cv(prepared, active, key, build, folds).scores()
        rows.append((step, name, len(active), len(new), round(oof, 6), round(std, 6)))
    schema = (
        "step int, experiment string, n_features int, new_features int, oof_auc double, std_auc double"
    )
    return log_with_delta(df.sparkSession.createDataFrame(rows, schema))


def iterative_elimination(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    label: str,
    build: Callable[[], Estimator],
    folds: int,
    fold: str = "fold",
    percentile: float = ELIMINATION_PERCENTILE,
    max_rounds: int = ELIMINATION_ROUNDS,
    min_features: int = ELIMINATION_MIN_FEATURES,
    tolerance: float = ELIMINATION_TOLERANCE,
) -> tuple[list[str], DataFrame]:
    """Drop the least important features round by round while the AUC holds."""

    def fitted(columns: Sequence[str]) -> CvResult:
        return run_cv(prepare(df, columns, key, label, fold), columns, key, build, folds)

    current, result = list(features), fitted(features)
    best = result.scores()[0]
    history = [(0, len(current), best, 0)]
    for number in range(1, max_rounds + 1):
        if len(current) <= min_features:
            break
        importance = mean_importance(fold_importances(result))
        weak = {r["feature"] for r in importance_cutoff(importance, percentile).collect()}
        candidate = [c for c in current if c not in weak]
        if len(candidate) < min_features:
            break
        trial = fitted(candidate)
        score = trial.scores()[0]
        history.append((number, len(candidate), score, len(weak)))
        if score - best < -tolerance:
            break
        current, result, best = candidate, trial, score
    schema = "round int, n_features int, oof_auc double, dropped int"
    return current, df.sparkSession.createDataFrame(history, schema)


def random_search(
    prepared: DataFrame,
    space: Mapping[str, Callable[[random.Random], object]],
    trials: int,
    folds: int = 3,
    parallelism: int = 2,
    seed: int = 42,
    base: BoostParams = LEARNER_A,
) -> DataFrame:
    """Mean cross-validated AUC of randomly drawn boosted-tree settings, best first.

    ``space`` maps an estimator parameter to a draw from a seeded generator.
    """
    rng = random.Random(seed)
    estimator = boosted(base)()
    estimator.clear(estimator.getParam("validationIndicatorCol"))
    drawn = [{name: draw(rng) for name, draw in space.items()} for _ in range(trials)]
    grid = [
        {estimator.getParam(name): value for name, value in setting.items()} for setting in drawn
    ]
    tuner = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol="label", numBins=0),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    fitted = tuner.fit(prepared.withColumn("fold", F.pmod("fold", F.lit(folds)).cast("int")))
    rows = [
        (i, str(sorted(setting.items())), float(auc))
        for i, (setting, auc) in enumerate(zip(drawn, fitted.avgMetrics, strict=True))
    ]
    table = prepared.sparkSession.createDataFrame(
        rows, "trial int, settings string, mean_auc double"
    )
    return table.orderBy(F.col("mean_auc").desc(), "trial")
