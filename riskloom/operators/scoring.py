"""Training flow, the model bundle it produces, and batch scoring with it."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import flag, nan_to_null, sentinel_to_null
from riskloom.operators import ensemble, metrics
from riskloom.operators.application import application_features
from riskloom.operators.assemble import KEY, TARGET, align
from riskloom.operators.calibration import (
    Calibrator,
    IsotonicCalibrator,
    SigmoidCalibrator,
    calibrate_with_split,
)
from riskloom.operators.encoders import OrdinalEncoder, OrdinalModel
from riskloom.operators.explain import (
    check_feature_order,
    explained_scores,
    named_contributions,
    top_reasons,
    tree_contributions,
)
from riskloom.operators.folds import stratified_folds
from riskloom.operators.selection import select_by_fold
from riskloom.operators.training import (
    LEARNER_A,
    LEARNER_B,
    BoostParams,
    boosted,
    filled_sql,
    prepare,
    run_cv,
)
from riskloom.plans.lineage import checkpointed
from riskloom.plans.shape import report_rows

# Decision threshold and the costs of wrong decisions.
THRESHOLD = 0.15
FP_COST, FN_COST = 1.0, 5.0


@dataclass(frozen=True)
class TrainConfig:
    folds: int = 5
    inner_folds: int = 3
    n_features: int | None = 200
    method: str | None = "mutual_info"
    learner_a: BoostParams = LEARNER_A
    learner_b: BoostParams = LEARNER_B
    threshold: float = THRESHOLD
    fp_cost: float = FP_COST
    fn_cost: float = FN_COST
    calibration_share: float = 0.5
    blend_steps: int = ensemble.GRID_STEPS
    seed: int = 42


@dataclass
class Bundle:
    """Everything needed to score: encoder, column order, models, blend, calibrator."""

    features: list[str]
    models_a: list[Model]
    models_b: list[Model]
    weight: float
    chosen_a: list[list[str]]
    chosen_b: list[list[str]]
    calibrator: Calibrator | None = None
    encoder: OrdinalModel | None = None
    threshold: float = THRESHOLD
    key: str = KEY
    metadata: dict[str, float | str] = field(default_factory=dict)

    def matrix(self, df: DataFrame, engineer: bool = True) -> DataFrame:
        """Raw rows to (key, features in training order): the same cleaning as in training."""
        rows = sentinel_to_null(nan_to_null(df))
        rows = sentinel_to_null(rows, ["CODE_GENDER"], "XNA")
        if engineer:
            rows = application_features(rows)
        if self.encoder is not None:
            rows = self.encoder.transform(rows)
        return align(rows, [self.key, *self.features])

    def probabilities(self, matrix: DataFrame, keep_features: bool = False) -> DataFrame:
        """Blended, uncalibrated score ``p``: mean per learner group, then the blend."""
        filled = matrix.selectExpr(f"`{self.key}`", *[filled_sql(c) for c in self.features])
        rows = VectorAssembler(inputCols=self.features, outputCol="features").transform(filled)
        groups = []
        for name, models, picks in (
            ("a", self.models_a, self.chosen_a),
            ("b", self.models_b, self.chosen_b),
        ):
            columns = []
            for i, (model, pick) in enumerate(zip(models, picks, strict=True)):
                out, inputs = f"_p_{name}{i}", f"_x_{name}{i}"
                at = [self.features.index(c) for c in pick]
                slicer = VectorSlicer(inputCol="features", outputCol=inputs, indices=at)
                quiet = model.copy().setProbabilityCol(out).setFeaturesCol(inputs)
                quiet = quiet.setRawPredictionCol("").setPredictionCol("")
                rows = quiet.transform(slicer.transform(rows)).drop(inputs)
                columns.append(F.get(vector_to_array(out), F.lit(1)))
            groups.append(ensemble.equal_blend(columns) if columns else None)
        a, b = groups
        if a is not None and b is not None:
            score = ensemble.blend(a, b, self.weight)
        else:
            score = a if a is not None else b
        kept = self.features if keep_features else []
        return rows.select(self.key, *kept, score.alias("p"))

    def score(
        self,
        df: DataFrame,
        threshold: float | None = None,
        reasons: bool = False,
        engineer: bool = True,
    ) -> DataFrame:
        """(key, predicted_pd, decision[, top_reasons]); the decision uses the
        unrounded probability."""
        limit = self.threshold if threshold is None else threshold
        matrix = self.matrix(df, engineer)
        scored = self.probabilities(matrix, keep_features=reasons)
        if self.calibrator is not None:
            scored = self.calibrator.transform(scored, "p", "pd")
        else:
            scored = scored.withColumn("pd", F.col("p"))
        columns = [
            F.col(self.key),
            F.round("pd", 6).alias("predicted_pd"),
            flag(F.col("pd") >= limit).alias("decision"),
        ]
        if reasons:
            scored = self.contributions(scored, carry=["pd"])
            columns.append(self._reasons())
        return scored.select(*columns)

    def contributions(self, matrix: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        models = [*self.models_a, *self.models_b]
        chosen = [*self.chosen_a, *self.chosen_b]
        return tree_contributions(matrix, self.key, self.features, models, chosen, carry)

    def _reasons(self) -> Column:
        pairs = named_contributions(F.col("contributions"), self.features)
        return top_reasons(pairs, digits=6).alias("top_reasons")

    def explain(self, matrix: DataFrame) -> DataFrame:
        """Calibrated score, log-odds, base and the top reasons of every row."""
        check_feature_order([c for c in matrix.columns if c != self.key], self.features)
        scored = explained_scores(self.contributions(matrix), self.key, self.calibrator)
        return scored.select("*", self._reasons())

    # -- storage ------------------------------------------------------------------

    def save(self, path: str) -> None:
        """Models in Spark ML format, the encoder map as Parquet, the rest as one JSON row."""
        spark = SparkSession.getActiveSession()
        assert spark is not None
        for name, models in (("a", self.models_a), ("b", self.models_b)):
            for i, model in enumerate(models):
                model.write().overwrite().save(f"{path}/model_{name}_{i}")
        meta: dict[str, object] = {
            "features": self.features,
            "chosen_a": self.chosen_a,
            "chosen_b": self.chosen_b,
            "weight": self.weight,
            "threshold": self.threshold,
            "key": self.key,
            "metadata": self.metadata,
            "calibrator": None,
            "encoded": None,
        }
        if isinstance(self.calibrator, SigmoidCalibrator):
            meta["calibrator"] = ["sigmoid", self.calibrator.slope, self.calibrator.intercept]
        elif isinstance(self.calibrator, IsotonicCalibrator):
            self.calibrator.model.write().overwrite().save(f"{path}/calibrator")
            meta["calibrator"] = ["isotonic"]
        if self.encoder is not None:
            self.encoder.mapping.write.mode("overwrite").parquet(f"{path}/encoder")
            meta["encoded"] = self.encoder.columns
        row = spark.createDataFrame([(json.dumps(meta),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/bundle")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        row = spark.read.text(f"{path}/bundle").first()
        assert row is not None
        meta = json.loads(row["value"])

        def models(name: str, n: int) -> list[Model]:
            return [GBTClassificationModel.load(f"{path}/model_{name}_{i}") for i in range(n)]

        calibrator: Calibrator | None = None
        kind = meta["calibrator"]
        if kind and kind[0] == "sigmoid":
            calibrator = SigmoidCalibrator(kind[1], kind[2])
        elif kind:
            calibrator = IsotonicCalibrator(IsotonicRegressionModel.load(f"{path}/calibrator"))
        encoder = None
        if meta["encoded"] is not None:
            encoder = OrdinalModel(meta["encoded"], spark.read.parquet(f"{path}/encoder"))
        return cls(
            meta["features"],
            models("a", len(meta["chosen_a"])),
            models("b", len(meta["chosen_b"])),
            meta["weight"],
            meta["chosen_a"],
            meta["chosen_b"],
            calibrator,
            encoder,
            meta["threshold"],
            meta["key"],
            meta["metadata"],
        )


@dataclass
class TrainResult:
    bundle: Bundle
    metrics: DataFrame
    oof: DataFrame


def train(
    features: DataFrame,
    config: TrainConfig = TrainConfig(),
    key: str = KEY,
    target: str = TARGET,
    exclude: Sequence[str] = (),
) -> TrainResult:
    """Encode, select, train two learners out of fold, blend, calibrate, evaluate.

    ``features`` is a feature matrix (see :mod:`riskloom.operators.assemble`) with the
    target. Each fold selects its features from the rows of the other folds; calibrated
    metrics come from the half the calibrator did not see.
    """
    # the feature matrix is read by the folds, the encoder and the encoded table: build it once
    labelled = checkpointed(features.where(F.col(target).isNotNull()))
    folded = stratified_folds(labelled, key, target, config.folds, config.seed)
    inputs = [c for c in features.columns if c not in (key, target, *exclude)]
    encoder = OrdinalEncoder([c for c, t in features.dtypes if t == "string" and c in inputs])
    encoded_by = encoder.fit(folded.select(inputs))
    frozen = checkpointed(encoded_by.transform(folded))
    chosen = select_by_fold(
        frozen, inputs, target, key, "fold", config.folds, config.method, config.n_features
    )
    used = [c for c in inputs if any(c in pick for pick in chosen)]

    results = {}
    for name, params in (("a", config.learner_a), ("b", config.learner_b)):
        rows = prepare(frozen, used, key, target, "fold", params.positive_weight)
        results[name] = run_cv(rows, used, key, boosted(params), config.folds, chosen)
    a = results["a"].oof.withColumnRenamed("p", "p_a")
    b = results["b"].oof.select(key, F.col("p").alias("p_b"))
    both = a.join(b, key)

    inner = stratified_folds(both, key, "label", config.inner_folds, config.seed, name="inner_fold")
    by_fold = ensemble.blend_weight_by_fold(
        inner, "p_a", "p_b", "label", "inner_fold", config.blend_steps
    )
    weight_row = ensemble.blend_weight(by_fold).first()
    assert weight_row is not None
    weight, inner_auc = float(weight_row["weight"]), float(weight_row["inner_auc"])
    blended = checkpointed(
        both.withColumn("p", ensemble.blend(F.col("p_a"), F.col("p_b"), weight))
    )

    calibrated = calibrate_with_split(
        blended, key, "p", "label", config.calibration_share, seed=config.seed
    )
    final = metrics.report(
        calibrated.evaluated,
        "label",
        "calibrated",
        config.threshold,
        fp_cost=config.fp_cost,
        fn_cost=config.fn_cost,
    ).first()
    blend_row = metrics.auc(blended, score="p").first()
    assert final is not None and blend_row is not None

    values: dict[str, float] = {
        "auc_a_cv_mean": results["a"].scores()[1],
        "auc_b_cv_mean": results["b"].scores()[1],
        "auc_blend_oof": float(blend_row["auc"]),
        "auc_blend_inner": inner_auc,
        "auc_calibrated": float(final["auc"]),
        "brier_calibrated": float(final["brier"]),
        "ks_calibrated": float(final["ks"]),
        "expected_loss": float(final["expected_loss"]),
        "weight_a": weight,
        "n_features": float(len(used)),
    }
    for name, result in results.items():
        for row in result.fold_metrics().collect():
            values[f"auc_{name}_fold_{row['fold']}"] = float(row["auc"])
    spark = features.sparkSession
    wide = spark.createDataFrame(
        [tuple(values.values())], ", ".join(f"`value__{m}` double" for m in values)
    )
    bundle = Bundle(
        used,
        results["a"].models,
        results["b"].models,
        weight,
        results["a"].chosen,
        results["b"].chosen,
        calibrated.best_calibrator,
        encoded_by,
        config.threshold,
        key,
        {"calibration": calibrated.best, **values},
    )
    table = report_rows(wide, list(values), {"value": "double"}, "metric")
    return TrainResult(bundle, table, blended)
