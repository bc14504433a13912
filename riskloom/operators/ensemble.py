"""Combining the scores of several models."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import flag, grid_point, total
from riskloom.operators.metrics import auc_expr
from riskloom.operators.training import probability
from riskloom.plans.lineage import checkpointed
from riskloom.plans.ordering import running_totals

GRID_STEPS = 100
SEARCH_DIGITS = 6
CELL_DIGITS = 3


def weighted(scores: Sequence[Column], weights: Sequence[float | Column]) -> Column:
    return total([s * w for s, w in zip(scores, weights, strict=True)])


def blend(a: Column, b: Column, weight: float | Column) -> Column:
    """weight * a + (1 - weight) * b"""
    return a * weight + b * (1.0 - weight)


def equal_blend(scores: Sequence[Column]) -> Column:
    return total(list(scores)) / float(len(scores))


def _distinct_scores(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct scores: one pass over the rows for any search."""
    y = F.col(label) == 1
    known = df.where(F.col(label).isNotNull())
    return known.groupBy(*keys).agg(F.sum(flag(y)).alias("pos"), F.sum(flag(~y)).alias("neg"))


def score_cells(
    df: DataFrame,
    scores: Sequence[str],
    label: str = "label",
    fold: str | None = None,
    digits: int = CELL_DIGITS,
) -> DataFrame:
    """Positives and negatives per fold and joint cell of the scores: (fold, scores, pos, neg).

    Each score is put on a grid of ``digits`` decimals, so continuous scores shrink too: at
    most folds x (10**digits + 1) ** scores rows, whatever the rows of ``df``. Searches over
    the table never read the rows again. Rows with an unknown score are in no cell.
    """
    scale = float(10**digits)
    on_grid = {c: (grid_point(F.col(c), digits) / F.lit(scale)).alias(c) for c in scores}
    known = df.dropna(subset=list(scores))
    keys = [fold] if fold else []
    rows = known.select(*keys, label, *on_grid.values())
    return checkpointed(_distinct_scores(rows, label, [*keys, *scores]))


def _candidate_counts(
    rows: DataFrame, score: Column, keys: Sequence[str], digits: int
) -> DataFrame:
    """Positives and negatives per (keys, score on the grid).

    Distinct scores are repeated once per candidate inside a task and summed there, so
    what is shuffled depends on the grid and the number of candidates, not on the rows.
    """
    return rows.groupBy(*keys, grid_point(score, digits).alias("_score")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )


def _grid_auc(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = {"pos": F.col("pos"), "neg": F.col("neg")}
    totals = running_totals(counts, keys, "_score", sums, grid=True)
    return totals.groupBy(*keys).agg(auc_expr().alias("auc"))


def blend_weight_by_fold(
    df: DataFrame,
    a: str,
    b: str,
    label: str = "label",
    fold: str = "inner_fold",
    steps: int = GRID_STEPS,
    digits: int = SEARCH_DIGITS,
) -> DataFrame:
    """Per inner fold: the weight with the best AUC on the other folds, that AUC, and
    the AUC of the same weight on the fold itself.

    AUC is a step function of the weight, so a grid over [0, 1] is searched; a tie
    goes to the smaller weight. Scores are compared on a grid of ``digits`` decimals.
    """
    grid = F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("w")
    rows = _distinct_scores(df, label, [fold, a, b]).select("*", grid)
    mixed = blend(F.col(a), F.col(b), F.col("w") / float(steps))
    counts = checkpointed(_candidate_counts(rows, mixed, ["w", fold], digits))
    folds = [r[fold] for r in counts.select(fold).distinct().collect()]
    # a row of fold k counts in the training part of every other fold
    others = F.array_except(F.array(*[F.lit(k) for k in folds]), F.array(F.col(fold)))
    train = (
        counts.select("w", "_score", "pos", "neg", F.explode(others).alias("held"))
        .groupBy("held", "w", "_score")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    on_train = _grid_auc(train, ["held", "w"])
    best = on_train.groupBy("held").agg(
        F.max(F.struct(F.col("auc"), (-F.col("w")).alias("neg_w"))).alias("_best")
    )
    best = best.select(
        F.col("held").alias(fold),
        (-F.col("_best.neg_w")).alias("w"),
        F.col("_best.auc").alias("train_auc"),
    )
    on_held = _grid_auc(counts, [fold, "w"]).withColumnRenamed("auc", "held_auc")
    return best.join(on_held, [fold, "w"]).select(
        fold, (F.col("w") / float(steps)).alias("weight"), "train_auc", "held_auc"
    )


def blend_weight_on_cells(
    cells: DataFrame,
    a: str,
    b: str,
    fold: str = "inner_fold",
    steps: int = GRID_STEPS,
    digits: int = SEARCH_DIGITS,
) -> DataFrame:
    """:func:`blend_weight_by_fold` over :func:`score_cells`.

    The pairs a training part ranks rightly are those of all rows less those with a row of
    its own fold on either side, so every candidate is ranked once for all folds together
    and once by fold; no training part is built.
    """
    grid = F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("w")
    mixed = blend(F.col(a), F.col(b), F.col("w") / float(steps))
    counts = checkpointed(_candidate_counts(cells.select("*", grid), mixed, ["w", fold], digits))
    sums = {"pos": F.col("pos"), "neg": F.col("neg")}

    def right(pos: str, before: str, neg: str) -> Column:
        return F.sum(F.col(pos).cast("double") * (F.col(before) + F.col(neg) / F.lit(2.0)))

    every = running_totals(counts, ["w"], "_score", sums, grid=True).select(
        F.col("w").alias("w_all"),
        F.col("_score").alias("score_all"),
        *[F.col(c).alias(f"all_{c}") for c in ("pos", "neg", "before_neg", "total_pos", "total_neg")],
        (F.col("total_pos") - F.col("before_pos") - F.col("pos")).alias("all_after_pos"),
    )
    whole = every.groupBy("w_all").agg(right("all_pos", "all_before_neg", "all_neg").alias("right_all"))
    own = running_totals(counts, ["w", fold], "_score", sums, grid=True)
    met = own.join(every, (F.col("w") == F.col("w_all")) & (F.col("_score") == F.col("score_all")))
    sides = met.groupBy("w", fold).agg(
        right("pos", "before_neg", "neg").alias("both"),
        (right("pos", "all_before_neg", "all_neg") + right("neg", "all_after_pos", "all_pos")).alias("either"),
        *[F.max(c).alias(c) for c in ("total_pos", "total_neg", "all_total_pos", "all_total_neg")],
    )

    def area(wins: Column, pos: Column, neg: Column) -> Column:
        # a part without one of the classes has no area
        return F.try_divide(wins, pos.cast("double") * neg)

    pos, neg = F.col("total_pos"), F.col("total_neg")
    areas = sides.join(whole, F.col("w") == F.col("w_all")).select(
        fold,
        "w",
        area(
            F.col("right_all") - F.col("either") + F.col("both"),
            F.col("all_total_pos") - pos,
            F.col("all_total_neg") - neg,
        ).alias("train_auc"),
        area(F.col("both"), pos, neg).alias("held_auc"),
    )
    best = F.max_by(F.struct("w", "train_auc", "held_auc"), F.struct("train_auc", -F.col("w")))
    picked = areas.groupBy(fold).agg(best.alias("best"))
    return picked.select(
        fold, (F.col("best.w") / float(steps)).alias("weight"), "best.train_auc", "best.held_auc"
    )


def blend_weight(by_fold: DataFrame) -> DataFrame:
    """One row: median of the per-fold weights and mean of the held-out AUC."""
    return by_fold.agg(
        F.median("weight").alias("weight"), F.avg("held_auc").alias("inner_auc")
    )


def simplex_candidates(n: int, trials: int = 300, seed: int = 42) -> list[list[float]]:
    """Equal weights, each model alone, and seeded draws from the simplex."""
    rng = random.Random(seed)
    out = [[1.0 / n] * n] + [[1.0 if i == j else 0.0 for j in range(n)] for i in range(n)]
    while len(out) < trials:
        draw = [rng.expovariate(1.0) for _ in range(n)]
        out.append([d / sum(draw) for d in draw])
    return out


def simplex_search(
    df: DataFrame,
    scores: Sequence[str],
    candidates: Sequence[Sequence[float]],
    label: str = "label",
    digits: int = SEARCH_DIGITS,
    cells: DataFrame | None = None,
) -> DataFrame:
    """AUC of every weight vector, best first; a tie goes to the earlier candidate.

    ``cells`` from :func:`score_cells` takes the place of the rows of ``df``.
    """
    options = F.array(
        *[
            F.struct(F.lit(i).alias("candidate"), F.array(*map(F.lit, w)).alias("weights"))
            for i, w in enumerate(candidates)
        ]
    )
    rows = _distinct_scores(df, label, scores) if cells is None else cells
    rows = rows.select("*", F.inline(options))
    mixed = weighted(
        [F.col(s) for s in scores], [F.get("weights", F.lit(i)) for i in range(len(scores))]
    )
    areas = _grid_auc(
        _candidate_counts(rows, mixed, ["candidate"], digits), ["candidate"]
    )
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(i, [float(x) for x in w]) for i, w in enumerate(candidates)],
        "candidate int, weights array<double>",
    )
    return areas.join(F.broadcast(table), "candidate").orderBy(F.col("auc").desc(), "candidate")


def stack(
    df: DataFrame,
    scores: Sequence[str],
    key: str,
    folds: int,
    label: str = "label",
    fold: str = "fold",
    c: float = 1.0,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Out-of-fold scores of a logistic model over standardised base scores.

    ``extra`` adds original features to the inputs of the meta-model.
    """
    inputs = [*scores, *extra]
    scale = Pipeline(
        stages=[
            VectorAssembler(inputCols=inputs, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        ]
    )
    base = df.select(
        key, F.col(label).cast("double").alias("label"), F.col(fold).alias("fold"), *inputs
    )
    rows = checkpointed(scale.fit(base).transform(base).drop("_raw"))
    out = None
    for k in range(folds):
        train = rows.where(F.col("fold") != k)
        # penalty of 1/(2C) on the summed loss is 1/(C n) on Spark's mean loss
        penalty = 1.0 / (c * max(train.count(), 1))
        model = LogisticRegression(regParam=penalty, standardization=False, maxIter=100).fit(train)
        part = model.transform(rows.where(F.col("fold") == k)).select(
            key, "fold", "label", probability().alias("p")
        )
        out = part if out is None else out.unionByName(part)
    assert out is not None
    return checkpointed(out)


def best_by_auc(table: DataFrame, name: str = "method") -> DataFrame:
    """The ensemble with the highest AUC; the first name on a tie."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("auc").desc(), name)
    # one row per compared method
    return table.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
