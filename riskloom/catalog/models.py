"""Registered queries: ensembles, calibration, training, explanations, streams."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.features import clean_application, credit_tables
from riskloom.catalog.profile import EMBED, EMBED_SQL, embedding_features
from riskloom.catalog.registry import query, table
from riskloom.catalog.views import spark_view, with_views
from riskloom.functions.columns import flag
from riskloom.operators import (
    assemble,
    calibration,
    category_learner,
    drift,
    ensemble,
    explain,
    folds,
    metrics,
    scoring,
    stacking,
    training,
)
from riskloom.plans.lineage import scratch_path
from riskloom.plans.shape import rounded
from riskloom.streaming import scoring as streams

SCORED = with_views("scored")

# -- blending -----------------------------------------------------------------------


@query(
    "blended_scores",
    SCORED
    + """
SELECT id, round(0.58 * score_a + (1 - 0.58) * score_b, 6) AS blended,
  round((score_a + score_b) / 2, 6) AS equal FROM scored""",
)
def blended_scores(spark: SparkSession, sf: str) -> DataFrame:
    a, b = F.col("score_a"), F.col("score_b")
    return spark_view(spark, sf, "scored").select(
        "id",
        F.round(ensemble.blend(a, b, 0.58), 6).alias("blended"),
        F.round(ensemble.equal_blend([a, b]), 6).alias("equal"),
    )


_GRID_SQL = (
    SCORED
    + """, x AS (
  SELECT id % 3 AS fold, w, label,
    CAST(floor((score_a * (w / 20e0) + score_b * (1 - w / 20e0)) * 1e6 + 0.5) AS BIGINT) AS s
  FROM scored, range(21) AS r(w)),
tr AS (SELECT h.fold AS held, w, s, sum(label) AS pos, sum(1 - label) AS neg
  FROM x JOIN (SELECT DISTINCT fold FROM x) h ON x.fold <> h.fold GROUP BY 1, 2, 3),
tc AS (SELECT *, sum(neg) OVER (PARTITION BY held, w ORDER BY s) - neg AS bn,
  sum(pos) OVER (PARTITION BY held, w) AS p, sum(neg) OVER (PARTITION BY held, w) AS n FROM tr),
ta AS (SELECT held, w, sum(pos * (bn + neg / 2e0)) / max(p * n) AS auc FROM tc GROUP BY 1, 2),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY held ORDER BY auc DESC, w) AS r FROM ta) WHERE r = 1),
va AS (SELECT fold, w, s, sum(label) AS pos, sum(1 - label) AS neg FROM x GROUP BY 1, 2, 3),
vc AS (SELECT *, sum(neg) OVER (PARTITION BY fold, w ORDER BY s) - neg AS bn,
  sum(pos) OVER (PARTITION BY fold, w) AS p, sum(neg) OVER (PARTITION BY fold, w) AS n FROM va),
vauc AS (SELECT fold, w, sum(pos * (bn + neg / 2e0)) / max(p * n) AS auc FROM vc GROUP BY 1, 2),
picked AS (SELECT b.held AS fold, b.w / 20e0 AS weight, b.auc AS train_auc, v.auc AS held_auc
  FROM best b JOIN vauc v ON v.fold = b.held AND v.w = b.w)"""
)


def _inner(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark_view(spark, sf, "scored").select("id", "label", "score_a", "score_b")
    return folds.key_ordered_folds(rows, "id", 3, "inner_fold")


@query(
    "blend_weight_by_fold",
    _GRID_SQL
    + """
SELECT CAST(fold AS INTEGER) AS inner_fold, weight, round(train_auc, 6) AS train_auc,
  round(held_auc, 6) AS held_auc FROM picked""",
)
def blend_weight_by_fold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        ensemble.blend_weight_by_fold(_inner(spark, sf), "score_a", "score_b", steps=20)
    )


@query(
    "blend_weight_nested",
    _GRID_SQL
    + " SELECT round(median(weight), 6) AS weight, round(avg(held_auc), 6) AS inner_auc FROM picked",
)
def blend_weight_nested(spark: SparkSession, sf: str) -> DataFrame:
    by_fold = ensemble.blend_weight_by_fold(_inner(spark, sf), "score_a", "score_b", steps=20)
    return rounded(ensemble.blend_weight(by_fold))


_CELLS_SQL = (
    SCORED
    + """, cells AS (
  SELECT id % 3 AS fold, floor(score_a * 1e3 + 0.5) / 1e3 AS a, floor(score_b * 1e3 + 0.5) / 1e3 AS b,
    sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1, 2, 3),
x AS (
  SELECT fold, w, CAST(floor((a * (w / 100e0) + b * (1 - w / 100e0)) * 1e6 + 0.5) AS BIGINT) AS s, pos, neg
  FROM cells, range(101) AS r(w)),
parts AS (
  SELECT 'train' AS part, h.fold, w, s, sum(pos) AS pos, sum(neg) AS neg
  FROM x JOIN (SELECT DISTINCT fold FROM x) h ON x.fold <> h.fold GROUP BY ALL
  UNION ALL SELECT 'held', fold, w, s, sum(pos), sum(neg) FROM x GROUP BY ALL),
ranked AS (SELECT *, sum(neg) OVER (PARTITION BY part, fold, w ORDER BY s) - neg AS before FROM parts),
areas AS (
  SELECT part, fold, w, sum(pos * (before + neg / 2e0)) / (sum(pos) * sum(neg)) AS auc
  FROM ranked GROUP BY part, fold, w)"""
)


@query(
    "blend_weight_on_cells",
    _CELLS_SQL
    + """
SELECT CAST(t.fold AS INTEGER) AS inner_fold, t.w / 100e0 AS weight, round(t.auc, 6) AS train_auc,
  round(h.auc, 6) AS held_auc
FROM areas t JOIN areas h ON h.part = 'held' AND h.fold = t.fold AND h.w = t.w
WHERE t.part = 'train'
QUALIFY row_number() OVER (PARTITION BY t.fold ORDER BY t.auc DESC, t.w) = 1""",
)
def blend_weight_on_cells(spark: SparkSession, sf: str) -> DataFrame:
    cells = ensemble.score_cells(_inner(spark, sf), ["score_a", "score_b"], fold="inner_fold")
    return rounded(ensemble.blend_weight_on_cells(cells, "score_a", "score_b"))


WEIGHTS = ensemble.simplex_candidates(3)


@query(
    "simplex_weights_on_cells",
    SCORED
    + ", c AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {a!r}::DOUBLE, {b!r}::DOUBLE, {c!r}::DOUBLE)" for i, (a, b, c) in enumerate(WEIGHTS))
    + """) v(candidate, wa, wb, wc)),
cells AS (
  SELECT floor(score_a * 1e2 + 0.5) / 1e2 AS a, floor(score_b * 1e2 + 0.5) / 1e2 AS b,
    floor(score_a * score_a * 1e2 + 0.5) / 1e2 AS c, sum(label) AS pos, sum(1 - label) AS neg
  FROM scored GROUP BY 1, 2, 3),
r AS (
  SELECT candidate, CAST(floor((cells.a * wa + cells.b * wb + cells.c * wc) * 1e6 + 0.5) AS BIGINT) AS s,
    sum(pos) AS pos, sum(neg) AS neg FROM cells, c GROUP BY 1, 2),
cu AS (SELECT *, sum(neg) OVER (PARTITION BY candidate ORDER BY s) - neg AS before FROM r)
SELECT candidate, round(sum(pos * (before + neg / 2e0)) / (sum(pos) * sum(neg)), 6) AS auc
FROM cu GROUP BY candidate""",
)
def simplex_weights_on_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark_view(spark, sf, "scored").select(
        "label", "score_a", "score_b", (F.col("score_a") * F.col("score_a")).alias("score_c")
    )
    names = ["score_a", "score_b", "score_c"]
    cells = ensemble.score_cells(rows, names, digits=2)
    return rounded(ensemble.simplex_search(rows, names, WEIGHTS, cells=cells).select("candidate", "auc"))


SIMPLEX = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0], [0.25, 0.5, 0.25], [0.5, 0.25, 0.25]]


@query(
    "simplex_weights",
    SCORED
    + """, c AS (SELECT * FROM (VALUES (0, 1e0, 0e0, 0e0), (1, 0e0, 1e0, 0e0), (2, 0e0, 0e0, 1e0),
  (3, 25e-2, 5e-1, 25e-2), (4, 5e-1, 25e-2, 25e-2)) v(candidate, wa, wb, wc)),
x AS (SELECT candidate, label,
  CAST(floor((score_a * wa + score_b * wb + score_a * score_a * wc) * 1e6 + 0.5) AS BIGINT) AS s FROM scored, c),
r AS (SELECT candidate, s, sum(label) AS pos, sum(1 - label) AS neg FROM x GROUP BY 1, 2),
cu AS (SELECT *, sum(neg) OVER (PARTITION BY candidate ORDER BY s) - neg AS bn,
  sum(pos) OVER (PARTITION BY candidate) AS p, sum(neg) OVER (PARTITION BY candidate) AS n FROM r)
SELECT candidate, round(sum(pos * (bn + neg / 2e0)) / max(p * n), 6) AS auc FROM cu GROUP BY candidate""",
)
def simplex_weights(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark_view(spark, sf, "scored").select(
        "label", "score_a", "score_b", (F.col("score_a") * F.col("score_a")).alias("score_c")
    )
    out = ensemble.simplex_search(rows, ["score_a", "score_b", "score_c"], SIMPLEX)
    return rounded(out.select("candidate", "auc"))


@query(
    "mean_over_models",
    """
WITH p AS (SELECT user_id AS id, value / (value + 50) AS p FROM events)
SELECT id, round(avg(p), 6) AS p FROM p GROUP BY id""",
)
def mean_over_models(spark: SparkSession, sf: str) -> DataFrame:
    """Stored scores of several models, averaged per row."""
    value = F.col("value")
    scores = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), (value / (value + 50)).alias("p")
    )
    return rounded(training.mean_scores([scores], "id"))


@query(
    "importance_by_group",
    """
WITH f AS (SELECT p_size % 5 AS fold, CASE p_type WHEN 'PROMO' THEN 'BUREAU_' WHEN 'SMALL' THEN 'CC_' ELSE 'PREV_' END || p_brand AS feature, p_retailprice AS importance FROM part),
m AS (SELECT feature, avg(importance) AS importance FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 40)
SELECT CASE WHEN starts_with(feature, 'BUREAU_') THEN 'bureau' WHEN starts_with(feature, 'CC_') THEN 'credit_card'
  ELSE 'previous_application' END AS feature_group, CAST(count(*) AS BIGINT) AS n_features, round(sum(importance), 4) AS importance
FROM m GROUP BY 1""",
)
def importance_by_group(spark: SparkSession, sf: str) -> DataFrame:
    from riskloom.functions.naming import attach_groups

    prefix = (
        F.when(F.col("p_type") == "PROMO", "BUREAU_").when(F.col("p_type") == "SMALL", "CC_")
    ).otherwise("PREV_")
    per_fold = table(spark, sf, "part").select(
        (F.col("p_size") % 5).alias("fold"),
        F.concat(prefix, F.col("p_brand")).alias("feature"),
        F.col("p_retailprice").alias("importance"),
    )
    grouped = attach_groups(training.mean_importance(per_fold, top=40))
    out = grouped.groupBy("feature_group").agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("importance").alias("importance")
    )
    return rounded(out, 4)


@query(
    "experiment_log_delta",
    """
WITH e AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS d, avg(value) AS v FROM events GROUP BY 1)
SELECT CAST(d AS VARCHAR) AS step, round(v, 6) AS oof_auc, round(coalesce(v - lag(v) OVER (ORDER BY d), 0), 6) AS delta FROM e""",
)
def experiment_log_delta(spark: SparkSession, sf: str) -> DataFrame:
    """A log with one row per day, each compared with the day before."""
    log = (
        table(spark, sf, "events")
        .groupBy(F.col("ts").cast("date").cast("string").alias("step"))
        .agg(F.avg("value").alias("oof_auc"))
    )
    return rounded(training.log_with_delta(log))


@query(
    "best_ensemble",
    SCORED
    + """, t AS (SELECT label, 'equal' AS method, (score_a + score_b) / 2 AS score FROM scored UNION ALL
  SELECT label, 'weighted', 0.7 * score_a + 0.3 * score_b FROM scored UNION ALL SELECT label, 'single', score_a FROM scored),
r AS (SELECT method, score, sum(label) AS pos, sum(1 - label) AS neg FROM t GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY method ORDER BY score) - neg AS bn,
    sum(pos) OVER (PARTITION BY method) AS p, sum(neg) OVER (PARTITION BY method) AS n FROM r),
a AS (SELECT method, sum(pos * (bn + neg / 2e0)) / max(p * n) AS auc FROM c GROUP BY method)
SELECT method, round(auc, 6) AS auc FROM a ORDER BY auc DESC, method LIMIT 1""",
)
def best_ensemble(spark: SparkSession, sf: str) -> DataFrame:
    from riskloom.plans.shape import tall

    a, b = F.col("score_a"), F.col("score_b")
    wide = spark_view(spark, sf, "scored").select(
        "label",
        ensemble.equal_blend([a, b]).alias("equal"),
        ensemble.weighted([a, b], [0.7, 0.3]).alias("weighted"),
        a.alias("single"),
    )
    long = tall(wide, ["equal", "weighted", "single"], ["label"], "method", "score")
    table_ = metrics.auc(long, keys=["method"]).select("method", "auc")
    return rounded(ensemble.best_by_auc(table_))


# -- calibration ----------------------------------------------------------------------


@query("calibration_by_split")
def calibration_by_split(spark: SparkSession, sf: str) -> DataFrame:
    """Brier score of both calibrators on the half they were not fitted on."""
    rows = spark_view(spark, sf, "scored").select("id", "label", F.col("score_a").alias("p"))
    return calibration.calibrate_with_split(rows, "id").brier_table()


@query(
    "sigmoid_calibration",
    # Newton steps of the two-parameter logistic likelihood
    SCORED.replace("WITH ", "WITH RECURSIVE ", 1)
    + """, steps AS (
  SELECT 0 AS i, 0e0 AS a, 0e0 AS b
  UNION ALL
  SELECT i + 1, max(a) + (sum(w) * sum(p * r) - sum(w * p) * sum(r)) / (sum(w) * sum(w * p * p) - sum(w * p) * sum(w * p)),
    max(b) + (sum(w * p * p) * sum(r) - sum(w * p) * sum(p * r)) / (sum(w) * sum(w * p * p) - sum(w * p) * sum(w * p))
  FROM (SELECT i, a, b, score_b AS p, label - 1 / (1 + exp(-(a * score_b + b))) AS r,
      1 / (1 + exp(-(a * score_b + b))) * (1 - 1 / (1 + exp(-(a * score_b + b)))) AS w
    FROM steps, scored WHERE i < 30)
  GROUP BY i)
SELECT id, round(score_b, 4) AS p, round(1 / (1 + exp(-(a * score_b + b))), 4) AS calibrated
FROM scored, (SELECT a, b FROM steps WHERE i = 30)""",
)
def sigmoid_calibration(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark_view(spark, sf, "scored").select("id", "label", F.col("score_b").alias("p"))
    out = calibration.fit_sigmoid(rows).transform(rows, "p", "calibrated")
    return rounded(out.drop("label"), 4)


@query(
    "isotonic_calibration",
    # max-min formula of the monotone fit, then interpolation between neighbouring knots
    SCORED
    + """, g AS (
  SELECT floor(score_b * 1e6 + 0.5) / 1e6 AS x, sum(label) AS s, count(*) AS n FROM scored GROUP BY 1),
o AS (SELECT row_number() OVER (ORDER BY x) AS i, x, s, n, sum(s) OVER (ORDER BY x) AS cs, sum(n) OVER (ORDER BY x) AS cn FROM g),
m AS (SELECT a.i AS j, b.i AS k, (b.cs - a.cs + a.s) / (b.cn - a.cn + a.n) AS v FROM o a JOIN o b ON a.i <= b.i),
f AS (SELECT j, k, min(v) OVER (PARTITION BY j ORDER BY k DESC ROWS UNBOUNDED PRECEDING) AS v FROM m),
knots AS (SELECT o.x, max(f.v) AS y FROM f JOIN o ON o.i = f.k GROUP BY o.x),
ends AS (SELECT x AS x0, y AS y0, lead(x) OVER (ORDER BY x) AS x1, lead(y) OVER (ORDER BY x) AS y1 FROM knots),
hit AS (SELECT id, score_b AS p, x0, y0, x1, y1 FROM scored ASOF LEFT JOIN ends ON score_b >= x0)
SELECT id, round(p, 6) AS p, round(CASE WHEN x0 IS NULL THEN (SELECT arg_min(y, x) FROM knots) WHEN x1 IS NULL THEN y0
  ELSE y0 + (y1 - y0) * (p - x0) / (x1 - x0) END, 6) AS calibrated FROM hit""",
)
def isotonic_calibration(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark_view(spark, sf, "scored").select("id", "label", F.col("score_b").alias("p"))
    out = calibration.fit_isotonic(rows).transform(rows, "p", "calibrated")
    return rounded(out.drop("label"))


# -- learners: a planted label on the embedding columns ----------------------------------

QUICK_A = training.BoostParams(max_iter=4, step_size=0.4, max_depth=3, min_rows=5, max_bins=16)
QUICK_B = training.BoostParams(
    max_iter=4, step_size=0.4, max_depth=4, min_rows=5, max_bins=16, positive_weight=2.5
)


def _prepared(spark: SparkSession, sf: str, k: int = 3, columns: list[str] | None = None):
    rows = folds.stratified_folds(embedding_features(spark, sf), "vec_id", "label", k)
    return training.prepare(rows, columns or EMBED, "vec_id", "label", positive_weight=1.0)


@query("boosted_trees_a_oof")
def boosted_trees_a_oof(spark: SparkSession, sf: str) -> DataFrame:
    return training.run_cv(_prepared(spark, sf), EMBED, "vec_id", training.boosted(QUICK_A), 3).oof


@query("boosted_trees_b_fold_auc")
def boosted_trees_b_fold_auc(spark: SparkSession, sf: str) -> DataFrame:
    result = training.run_cv(_prepared(spark, sf), EMBED, "vec_id", training.boosted(QUICK_B), 3)
    return result.fold_metrics()


@query("forest_cv_summary")
def forest_cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    build = training.forest(trees=20, max_depth=6, min_rows=5)
    return training.run_cv(_prepared(spark, sf), EMBED, "vec_id", build, 3).summary()


@query("fold_mean_importance")
def fold_mean_importance(spark: SparkSession, sf: str) -> DataFrame:
    build = training.forest(trees=20, max_depth=6, min_rows=5)
    result = training.run_cv(_prepared(spark, sf), EMBED, "vec_id", build, 3)
    return training.mean_importance(training.fold_importances(result), top=20)


@query("parameter_search")
def parameter_search(spark: SparkSession, sf: str) -> DataFrame:
    space = {
        "maxDepth": lambda r: r.randint(2, 4),
        "stepSize": lambda r: round(10 ** r.uniform(-1.0, -0.3), 3),
        "maxIter": lambda r: r.randint(2, 4),
    }
    few = EMBED[:8]
    return training.random_search(_prepared(spark, sf, 3, few), space, trials=2, base=QUICK_A)


@query("feature_group_ablation")
def feature_group_ablation(spark: SparkSession, sf: str) -> DataFrame:
    rows = folds.stratified_folds(embedding_features(spark, sf), "vec_id", "label", 3)
    groups = [("noise", EMBED[2:10]), ("+first", ["e0"]), ("+second", ["e1"])]
    build = training.forest(trees=10, max_depth=4, min_rows=5)
    return training.ablation(rows, groups, "vec_id", "label", build, 3)


@query("seed_runs")
def seed_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The default forest under three seeds, and the AUC of their averaged scores."""
    seeds = (42, 43, 44)
    runs = training.run_seeds(
        _prepared(spark, sf, 5), EMBED, "vec_id", lambda s: training.forest(seed=s), 5, seeds, parallel=3
    )
    whole = metrics.auc(runs.oof(), score="p").select(
        F.lit(len(seeds)).alias("step"), F.lit(None).cast("int").alias("seed"), F.col("auc").alias("oof_auc")
    )
    return training.log_with_delta(runs.log().unionByName(whole, allowMissingColumns=True))


@query("iterative_elimination")
def iterative_elimination(spark: SparkSession, sf: str) -> DataFrame:
    rows = folds.stratified_folds(embedding_features(spark, sf), "vec_id", "label", 3)
    build = training.forest(trees=10, max_depth=4, min_rows=5)
    _, history = training.iterative_elimination(
        rows, EMBED, "vec_id", "label", build, 3, percentile=40, max_rounds=2, min_features=10
    )
    return history


@query("stacked_scores")
def stacked_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark_view(spark, sf, "scored").select("id", "label", "score_a", "score_b")
    folded = folds.stratified_folds(rows, "id", "label", 3)
    return ensemble.stack(folded, ["score_a", "score_b"], "id", 3)


_STACK_STEPS = 12


def _newton_sql(step: int) -> str:
    """One Newton step of the ridge logistic models, all folds at once. Rows are (1, u, v)
    scaled; the penalty 1/C = 1 leaves out the intercept."""
    return f"""
p{step} AS MATERIALIZED (
  SELECT m.k, m.b, m.cu, m.cv, x.u, x.v, x.label AS y, 1 / (1 + exp(-(m.b + m.cu * x.u + m.cv * x.v))) AS p
  FROM m{step - 1} m JOIN x ON x.fold <> m.k),
s{step} AS MATERIALIZED (
  SELECT k, b, cu, cv, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * u) AS h01, sum(p * (1 - p) * v) AS h02,
    sum(p * (1 - p) * u * u) + 1 AS h11, sum(p * (1 - p) * u * v) AS h12, sum(p * (1 - p) * v * v) + 1 AS h22,
    sum(p - y) AS g0, sum((p - y) * u) + cu AS g1, sum((p - y) * v) + cv AS g2
  FROM p{step} GROUP BY k, b, cu, cv),
d{step} AS MATERIALIZED (
  SELECT *, h11 * h22 - h12 * h12 AS a00, h02 * h12 - h01 * h22 AS a01, h01 * h12 - h02 * h11 AS a02,
    h00 * h22 - h02 * h02 AS a11, h01 * h02 - h00 * h12 AS a12, h00 * h11 - h01 * h01 AS a22 FROM s{step}),
m{step} AS MATERIALIZED (
  SELECT k, b - (a00 * g0 + a01 * g1 + a02 * g2) / (h00 * a00 + h01 * a01 + h02 * a02) AS b,
    cu - (a01 * g0 + a11 * g1 + a12 * g2) / (h00 * a00 + h01 * a01 + h02 * a02) AS cu,
    cv - (a02 * g0 + a12 * g1 + a22 * g2) / (h00 * a00 + h01 * a01 + h02 * a02) AS cv FROM d{step})"""


@query(
    "stacked_old_and_new",
    # the newest quarter of the ids has no label when the stack is fitted
    SCORED
    + """, t AS (SELECT id, label, score_a, score_b, id % 4 = 3 AS is_new, id // 4 % 3 AS fold FROM scored),
w AS (SELECT avg(score_a) AS ma, stddev_samp(score_a) AS sa, avg(score_b) AS mb, stddev_samp(score_b) AS sb FROM t WHERE NOT is_new),
z AS (SELECT id, label, is_new, fold, (score_a - ma) / sa AS u, (score_b - mb) / sb AS v FROM t, w),
x AS MATERIALIZED (SELECT * FROM z WHERE NOT is_new),
m0 AS (SELECT k, 0e0 AS b, 0e0 AS cu, 0e0 AS cv FROM range(3) r(k)),"""
    + ",".join(map(_newton_sql, range(1, _STACK_STEPS + 1)))
    + f""",
q AS (SELECT z.id, z.is_new, 1 / (1 + exp(-(m.b + m.cu * z.u + m.cv * z.v))) AS p
  FROM z JOIN m{_STACK_STEPS} m ON z.is_new OR m.k = z.fold)
SELECT id, is_new, round(avg(p), 5) AS p FROM q GROUP BY id, is_new""",
)
def stacked_old_and_new(spark: SparkSession, sf: str) -> DataFrame:
    """A stack fitted on three quarters of the rows: out-of-fold scores there, the mean of
    the fold models on the others."""
    rows = spark_view(spark, sf, "scored").select(
        "id", "label", "score_a", "score_b", (F.col("id") % 4 == 3).alias("is_new"),
        F.pmod(F.floor(F.col("id") / 4), F.lit(3)).alias("fold"),
    )
    model = stacking.fit_stack(rows.where("NOT is_new"), ["score_a", "score_b"], 3)
    both = model.out_of_fold(model.transform(rows, "fresh"), name="own")
    p = F.when(F.col("is_new"), F.col("fresh")).otherwise(F.col("own"))
    return both.select("id", "is_new", F.round(p, 5).alias("p"))


_CATEGORIES = ("OCCUPATION_TYPE", "CODE_GENDER")
_ORDERED = "PARTITION BY k{} ORDER BY h, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _ordered_sql(column: str, name: str) -> str:
    """Training sums before the row, or of all training rows where the row is held out."""
    by = f", {column}" if column else ""
    before, whole = _ORDERED.format(by), f"PARTITION BY k{by}"
    return ", ".join(
        f"coalesce(CASE WHEN fold = k THEN sum({v}) OVER ({whole}) ELSE sum({v}) OVER ({before}) END, 0) AS {name}_{a}"
        for a, v in (("n", "w"), ("s", "w * y"))
    )


@query(
    "ordered_target_statistics",
    with_views("application")
    + """, o AS (SELECT SK_ID_CURR AS id, TARGET AS y, SK_ID_CURR % 3 AS fold, OCCUPATION_TYPE, CODE_GENDER,
    substr(md5('42|' || CAST(SK_ID_CURR AS VARCHAR)), 1, 15) AS h FROM application),
c AS (SELECT o.*, k, CASE WHEN fold <> k THEN 1 ELSE 0 END AS w FROM o, range(3) r(k)),
t AS (SELECT id, CAST(k AS INTEGER) AS model, """
    + ", ".join(
        _ordered_sql(column, name)
        for column, name in (("", "e"), ("OCCUPATION_TYPE", "o"), ("CODE_GENDER", "g"))
    )
    + """ FROM c), f AS (SELECT *, (e_s + 5e-1) / (e_n + 1) AS prior FROM t)
SELECT id AS SK_ID_CURR, model, round((o_s + prior) / (o_n + 1), 6) AS occupation,
  round((g_s + prior) / (g_n + 1), 6) AS gender FROM f""",
)
def ordered_target_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The code of every row and category column as each of three fold models sees it."""
    app = folds.key_ordered_folds(spark_view(spark, sf, "application"), "SK_ID_CURR", 3)
    rows = category_learner.ordered_codes(app, _CATEGORIES, "SK_ID_CURR", "TARGET", 3).rows
    both = F.arrays_zip(*[F.col(f"{c}_ots") for c in _CATEGORIES])
    long = rows.select("SK_ID_CURR", F.posexplode(both).alias("model", "code"))
    return rounded(
        long.select(
            "SK_ID_CURR", "model", F.col("code.OCCUPATION_TYPE_ots").alias("occupation"),
            F.col("code.CODE_GENDER_ots").alias("gender"),
        )
    )


@query("category_learner_auc")
def category_learner_auc(spark: SparkSession, sf: str) -> DataFrame:
    """The third learner at its default settings on raw categories: AUC of each of five folds
    and of all out-of-fold scores (fold NULL)."""
    app = spark_view(spark, sf, "application")
    rows = folds.stratified_folds(app, "SK_ID_CURR", "TARGET", 5)
    numbers = ["AMT_ANNUITY", "DAYS_BIRTH", "CNT_CHILDREN", "EXT_SOURCE_1", "EXT_SOURCE_3"]
    cv = category_learner.run_category_cv(
        rows, _CATEGORIES, numbers, "SK_ID_CURR", "TARGET", training.forest(), 5
    )
    overall = metrics.auc(cv.result.oof, score="p").withColumn("fold", F.lit(None).cast("int"))
    return cv.result.fold_metrics().unionByName(overall)


QUICK = scoring.TrainConfig(
    folds=2, n_features=30, learner_a=QUICK_A, learner_b=QUICK_B, blend_steps=20
)


def _train_features(spark: SparkSession, sf: str) -> DataFrame:
    """Full credit feature matrix of the customers, without the balance that defines
    the target."""
    leaking = [
        "AMT_INCOME_TOTAL",
        "AMT_CREDIT",
        "AMT_GOODS_PRICE",
        "EXT_SOURCE_2",
        "CREDIT_INCOME_RATIO",
        "ANNUITY_INCOME_RATIO",
        "CREDIT_TERM",
        "GOODS_CREDIT_RATIO",
        "INCOME_PER_PERSON",
        "CREDIT_PER_PERSON",
        "AMT_DOWN_PAYMENT_PROXY",
    ]
    app = clean_application(spark, sf)
    full = assemble.build_features(app, credit_tables(spark, sf))
    derived = [c for c in full.columns if c.startswith("EXT_") and c not in app.columns]
    return assemble.drop_columns(full, [*leaking, *derived])


@query("training_metrics")
def training_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flow: features, encode, select, two learners, blend, calibrate, evaluate."""
    return scoring.train(_train_features(spark, sf), QUICK).metrics


@query("batch_scoring")
def batch_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Train on the planted label, then score every row with reasons."""
    rows = embedding_features(spark, sf)
    result = scoring.train(rows, QUICK, "vec_id", "label")
    scored = result.bundle.score(rows, threshold=0.5, reasons=True, engineer=False)
    best = F.get("top_reasons", F.lit(0))
    return scored.select(
        "vec_id",
        "predicted_pd",
        "decision",
        best["feature"].alias("first_reason"),
        best["contribution"].alias("first_contribution"),
    )


# -- explanations -----------------------------------------------------------------------


@query(
    "tree_contribution_check",
    "SELECT CAST(count(*) AS BIGINT) AS n, TRUE AS sums_to_score FROM embeddings",
)
def tree_contribution_check(spark: SparkSession, sf: str) -> DataFrame:
    """Largest gap between base + contributions and the model's own log-odds."""
    prepared = _prepared(spark, sf, 2)
    model = training.run_cv(prepared, EMBED, "vec_id", training.boosted(QUICK_A), 2).models[0]
    rows = embedding_features(spark, sf)
    parts = explain.tree_contributions(rows, "vec_id", EMBED, [model])
    own = model.transform(prepared).select("vec_id", training.probability().alias("p"))
    raw = explain.explained_scores(parts, "vec_id").select("vec_id", "pd")
    gap = F.max(F.abs(F.col("pd") - F.col("p")))
    return own.join(raw, "vec_id").agg(
        F.count(F.lit(1)).alias("n"), (gap < 1e-6).alias("sums_to_score")
    )


# a hand-made tree: inner nodes are (feature, threshold, left, right), leaves are values;
# every node comes with its training rows
_TREE = (
    100,
    ("e0", 0.0, (60, ("e1", -0.1, (20, -1.5), (40, ("e0", -0.3, (10, 0.75), (30, 0.25))))),
     (40, ("e2", 0.2, (25, ("e1", 0.3, (15, 0.5), (10, 2.0))), (15, -0.5)))),
)
_TREE_FEATURES = ("e0", "e1", "e2")


def _tree_nodes() -> explain.TreeNodes:
    """The hand-made tree as node arrays."""
    rows: list[list[float]] = []

    def place(node) -> int:
        at = len(rows)
        rows.append([-1, -1, -1, 0.0, 0.0, node[0]])
        if isinstance(node[1], tuple):
            feature, threshold, left, right = node[1]
            rows[at][2:4] = [_TREE_FEATURES.index(feature), threshold]
            rows[at][:2] = [place(left), place(right)]
        else:
            rows[at][4] = node[1]
        return at

    place(_TREE)
    left, right, feature, threshold, value, cover = np.array(rows).T
    return explain.TreeNodes(
        left.astype(int), right.astype(int), feature.astype(int), threshold, value, 1.0, cover
    )


def _known_sql(node, known: tuple[str, ...]) -> str:
    """SQL of the tree's expected value when only some features are known."""
    cover, inside = node
    if not isinstance(inside, tuple):
        return f"{inside!r}e0"
    feature, threshold, left, right = inside
    low, high = _known_sql(left, known), _known_sql(right, known)
    if feature in known:
        return f"CASE WHEN {feature} <= {threshold!r} THEN {low} ELSE {high} END"
    return f"({left[0] / cover!r}e0 * ({low}) + {right[0] / cover!r}e0 * ({high}))"


def _shapley_sql(feature: str) -> str:
    """The feature's mean gain over all orders in which the features become known."""
    others = [f for f in _TREE_FEATURES if f != feature]
    terms = []
    for size, weight in ((0, 1 / 3), (1, 1 / 6), (2, 1 / 3)):
        for known in itertools.combinations(others, size):
            gain = f"({_known_sql(_TREE, (*known, feature))}) - ({_known_sql(_TREE, known)})"
            terms.append(f"{weight!r}e0 * ({gain})")
    return f"round({' + '.join(terms)}, 6) AS c_{feature}"


@query(
    "tree_shapley_values",
    f"WITH {EMBED_SQL} SELECT vec_id, round({_known_sql(_TREE, ())}, 6) AS base_value, "
    + ", ".join(map(_shapley_sql, _TREE_FEATURES))
    + " FROM e",
)
def tree_shapley_values(spark: SparkSession, sf: str) -> DataFrame:
    """Exact Shapley values of a hand-made tree on the embedding columns."""
    rows = embedding_features(spark, sf)
    out = explain.contributions_of_trees(rows, "vec_id", _TREE_FEATURES, [[_tree_nodes()]])
    values = [F.get("contributions", i).alias(f"c_{f}") for i, f in enumerate(_TREE_FEATURES)]
    return rounded(out.select("vec_id", "base_value", *values))


_COEF = {"e0": 1.5, "e1": -0.75, "e2": 0.25, "e3": 0.5}
_LINEAR_SQL = (
    "WITH "
    + EMBED_SQL
    + ", m AS (SELECT "
    + ", ".join(f"avg({c}) AS {c}" for c in _COEF)
    + " FROM e), k AS ("
    + " UNION ALL ".join(
        f"SELECT e.vec_id, '{c}' AS feature, e.{c} * {w} - m.{c} * {w} AS contribution FROM e, m"
        for c, w in _COEF.items()
    )
    + ")"
)


def _linear(spark: SparkSession, sf: str) -> DataFrame:
    rows = embedding_features(spark, sf)
    row = rows.agg(*[F.avg(c).alias(c) for c in _COEF]).first()
    assert row is not None
    return explain.linear_contributions(rows, "vec_id", _COEF, row.asDict())


@query(
    "linear_reasons",
    _LINEAR_SQL
    + """
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS rank,
  feature, round(contribution, 6) AS contribution FROM k QUALIFY rank <= 3""",
)
def linear_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(explain.reason_rows(_linear(spark, sf), "vec_id", 3))


@query(
    "global_contribution_ranking",
    _LINEAR_SQL
    + " SELECT feature, round(avg(abs(contribution)), 6) AS importance FROM k GROUP BY feature",
)
def global_contribution_ranking(spark: SparkSession, sf: str) -> DataFrame:
    rows = explain.contribution_rows(_linear(spark, sf), "vec_id")
    return rounded(explain.global_importance(rows))


@query(
    "linked_linear_scores",
    _LINEAR_SQL
    + """, s AS (SELECT vec_id, sum(contribution) - 2 AS raw FROM k GROUP BY vec_id)
SELECT vec_id, round(raw, 6) AS raw_score,
  round(1 / (1 + exp(-(1.2 * (1 / (1 + exp(-raw))) - 0.1))), 6) AS pd FROM s""",
)
def linked_linear_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Log-odds to probability first, calibration second."""
    packed = _linear(spark, sf).select(
        "vec_id",
        F.col("pairs.contribution").alias("contributions"),
        F.lit(-2.0).alias("base_value"),
    )
    calibrator = calibration.SigmoidCalibrator(1.2, -0.1)
    return explain.explained_scores(packed, "vec_id", calibrator).select("vec_id", "raw_score", "pd")


_CREDIT_SQL = (
    with_views("application")
    + """, m AS (SELECT avg(AMT_CREDIT) AS c, avg(DAYS_BIRTH) AS b, avg(CNT_CHILDREN) AS k FROM application),
t AS (SELECT SK_ID_CURR, 'AMT_CREDIT' AS feature, AMT_CREDIT * 1e-5 - c * 1e-5 AS contribution FROM application, m UNION ALL
  SELECT SK_ID_CURR, 'DAYS_BIRTH', DAYS_BIRTH * 1e-4 - b * 1e-4 FROM application, m UNION ALL
  SELECT SK_ID_CURR, 'CNT_CHILDREN', CNT_CHILDREN * 3e-1 - k * 3e-1 FROM application, m),
r AS (SELECT SK_ID_CURR, feature, CAST(row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY abs(contribution) DESC, feature) AS INTEGER) AS rank,
  contribution FROM t QUALIFY rank <= 2),
l AS (SELECT *, CASE feature WHEN 'AMT_CREDIT' THEN 'loan amount' WHEN 'DAYS_BIRTH' THEN 'applicant age' ELSE 'cnt children' END AS factor FROM r)"""
)


def _credit_pairs(spark: SparkSession, sf: str) -> DataFrame:
    app = spark_view(spark, sf, "application")
    weights = {"AMT_CREDIT": 1e-5, "DAYS_BIRTH": 1e-4, "CNT_CHILDREN": 0.3}
    row = app.agg(*[F.avg(c).alias(c) for c in weights]).first()
    assert row is not None
    return explain.linear_contributions(app, "SK_ID_CURR", weights, row.asDict())


@query(
    "structured_explanations",
    _CREDIT_SQL
    + """
SELECT SK_ID_CURR, rank, factor, CASE WHEN contribution > 0 THEN 'increases risk' ELSE 'decreases risk' END AS direction,
  round(abs(contribution), 5) AS impact FROM l""",
)
def structured_explanations(spark: SparkSession, sf: str) -> DataFrame:
    reasons = explain.reason_rows(_credit_pairs(spark, sf), "SK_ID_CURR", 2)
    return explain.explanation_rows(reasons, "SK_ID_CURR")


@query(
    "reason_letters",
    _CREDIT_SQL
    + """
SELECT SK_ID_CURR, string_agg(CAST(rank AS VARCHAR) || '. ' || upper(factor[1]) || substr(factor, 2) || ' - ' ||
  CASE WHEN contribution > 0 THEN 'Increases risk' ELSE 'Decreases risk' END, '; ' ORDER BY rank) AS reasons FROM l GROUP BY 1""",
)
def reason_letters(spark: SparkSession, sf: str) -> DataFrame:
    return explain.reason_text(_credit_pairs(spark, sf), "SK_ID_CURR", 2)


# -- streams ------------------------------------------------------------------------------


@query(
    "stream_scored_events",
    """
SELECT event_id, floor(value / (value + 50) * 1e6 + 0.5) / 1e6 AS predicted_pd,
  CASE WHEN value / (value + 50) >= 0.15 THEN 1 ELSE 0 END AS decision FROM events""",
)
def stream_scored_events(spark: SparkSession, sf: str) -> DataFrame:
    """The event file read as a stream, scored row by row, written once, read back."""
    from riskloom.functions.columns import grid_point

    schema = table(spark, sf, "events").schema
    stream = streams.parquet_stream(spark, sf, schema, "events.parquet")
    out = scratch_path(spark, "stream-scores")

    def score(df: DataFrame) -> DataFrame:
        p = F.col("value") / (F.col("value") + 50)
        return df.select(
            "event_id",
            (grid_point(p) / 1e6).alias("predicted_pd"),
            flag(p >= scoring.THRESHOLD).alias("decision"),
        )

    streams.score_stream(stream, score, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/rows")


@query(
    "stream_window_psi",
    """
WITH ref AS (SELECT value AS v FROM events WHERE ts < TIMESTAMP '2024-01-16'),
q AS (SELECT list_sort(list_distinct(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM ref),
pairs AS (SELECT i AS bin, e[i + 1] AS lo, e[i + 2] AS hi, i = len(e) - 2 AS is_last FROM q, range(10) AS r(i) WHERE i <= len(e) - 2),
refc AS (SELECT bin, sum(CASE WHEN v >= lo AND (v < hi OR (is_last AND v = hi)) THEN 1 ELSE 0 END)
    / (SELECT count(*) FROM ref) + 1e-6 AS r FROM pairs, ref GROUP BY bin),
cur AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, value AS v FROM events),
open AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events),
tot AS (SELECT day, count(*) AS n FROM cur, open WHERE day + INTERVAL 1 DAY <= mark GROUP BY day),
curc AS (SELECT day, bin, sum(CASE WHEN v >= lo AND (v < hi OR (is_last AND v = hi)) THEN 1 ELSE 0 END) AS c
  FROM pairs, cur GROUP BY day, bin)
SELECT CAST(tot.day AS VARCHAR) AS window_start, CAST(max(n) AS BIGINT) AS cur_total,
  round(sum((c / n + 1e-6 - r) * ln((c / n + 1e-6) / r)), 6) AS psi
FROM curc JOIN refc USING (bin) JOIN tot ON curc.day = tot.day GROUP BY tot.day""",
)
def stream_window_psi(spark: SparkSession, sf: str) -> DataFrame:
    """Daily PSI of a stream against frozen bins; only windows behind the watermark."""
    events = table(spark, sf, "events")
    early = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    out = scratch_path(spark, "stream-psi")
    drift.reference_profile(early, ["value"]).write.parquet(f"{out}/profile")
    profile = spark.read.parquet(f"{out}/profile")
    stream = streams.parquet_stream(spark, sf, events.schema, "events.parquet")
    counts = streams.window_counts(stream, profile, ["value"])
    streams.monitor_stream(counts, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    closed = spark.read.parquet(f"{out}/counts")
    return rounded(
        streams.window_psi(closed, profile).select(
            F.col("window_start").cast("string").alias("window_start"), "cur_total", "psi"
        )
    )


