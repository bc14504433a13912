"""Binary-classification metrics over (label, score) rows, optionally per group.

Ranking metrics come from :func:`riskloom.plans.ordering.running_totals`, so ties
count as ties and nothing is sorted in one task. With ``digits`` the score is
first put on a grid of that many decimals: the table of distinct scores is then
bounded (10**digits + 1 rows per group) however many rows are scored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import flag, grid_point, left_open_bin
from riskloom.plans.joins import lookup_join
from riskloom.plans.ordering import running_totals

LOG_CLIP = 1e-15


def ranked(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    keys: Sequence[str] = (),
    digits: int | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct scores with positives/negatives at, below and overall.

    ``extra`` adds plain sums over the rows, written in terms of ``_y`` and ``_p``.
    """
    value = F.col("_p") if digits is None else grid_point(F.col("_p"), digits)
    rows = (
        df.select(*keys, F.col(label).cast("double").alias("_y"), F.col(score).alias("_p"))
        .where(F.col("_y").isNotNull())
        .withColumn("_score", value)
    )
    sums = {"pos": flag(F.col("_y") == 1).cast("long"), "neg": flag(F.col("_y") != 1).cast("long")}
    sums.update(extra or {})
    return running_totals(rows, keys, "_score", sums, grid=digits is not None)


def _both() -> Column:
    """P * N as a double, NULL when one class is absent."""
    product = F.max("total_pos").cast("double") * F.max("total_neg").cast("double")
    return F.nullif(product, F.lit(0.0))


def auc_expr() -> Column:
    """ROC AUC over ranked rows; a tie between classes counts one half."""
    wins = F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / F.lit(2.0))
    return F.sum(wins) / _both()


def ks_expr() -> Column:
    """Largest gap of the two class distributions; 0.0 with a single class."""
    pos_share = F.try_divide(
        (F.col("before_pos") + F.col("pos")).cast("double"), F.col("total_pos").cast("double")
    )
    neg_share = F.try_divide(
        (F.col("before_neg") + F.col("neg")).cast("double"), F.col("total_neg").cast("double")
    )
    return F.coalesce(F.max(F.abs(pos_share - neg_share)), F.lit(0.0))


def average_precision_expr() -> Column:
    above_pos = (F.col("total_pos") - F.col("before_pos")).cast("double")
    above = above_pos + F.col("total_neg") - F.col("before_neg")
    gained = F.try_divide(F.col("pos").cast("double"), F.col("total_pos").cast("double"))
    return F.sum(gained * F.try_divide(above_pos, above))


def auc(df: DataFrame, label="label", score="score", keys: Sequence[str] = (), digits=None):
    """One row per group: number of rows, positives and ROC AUC."""
    return ranked(df, label, score, keys, digits).groupBy(*keys).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("n"),
        F.sum("pos").alias("positives"),
        auc_expr().alias("auc"),
    )


def ks_separation(df: DataFrame, label="label", score="score", keys: Sequence[str] = (), digits=None):
    return ranked(df, label, score, keys, digits).groupBy(*keys).agg(ks_expr().alias("ks"))


def brier_expr(label: str = "label", score: str = "score") -> Column:
    return F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0)))


def brier(df: DataFrame, label="label", score="score", keys: Sequence[str] = ()) -> DataFrame:
    """Brier score and the score of always predicting the base rate."""
    rate = F.avg(F.col(label).cast("double"))
    return df.groupBy(*keys).agg(
        brier_expr(label, score).alias("brier"), (rate * (1 - rate)).alias("brier_base_rate")
    )


def log_loss_expr(label: str = "label", score: str = "score") -> Column:
    p = F.greatest(F.lit(LOG_CLIP), F.least(F.lit(1.0 - LOG_CLIP), F.col(score)))
    return F.avg(-F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1.0 - p)))


def confusion(
    df: DataFrame, label="label", score="score", threshold: float = 0.5, keys: Sequence[str] = ()
) -> DataFrame:
    """Counts at ``score >= threshold``."""
    said, was = F.col(score) >= threshold, F.col(label) == 1
    return df.groupBy(*keys).agg(
        F.count_if(~said & ~was).alias("tn"),
        F.count_if(said & ~was).alias("fp"),
        F.count_if(~said & was).alias("fn"),
        F.count_if(said & was).alias("tp"),
    )


def expected_loss(
    df: DataFrame,
    label="label",
    score="score",
    threshold: float = 0.5,
    fp_cost: float = 1.0,
    fn_cost: float = 5.0,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Cost of wrong decisions per row."""
    counts = confusion(df, label, score, threshold, keys)
    n = F.greatest(F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"), F.lit(1))
    return counts.withColumn("expected_loss", (F.col("fp") * fp_cost + F.col("fn") * fn_cost) / n)


def report(
    df: DataFrame,
    label="label",
    score="score",
    threshold: float = 0.5,
    keys: Sequence[str] = (),
    digits: int | None = None,
    fp_cost: float = 1.0,
    fn_cost: float = 5.0,
) -> DataFrame:
    """All metrics of a scored table, one row per group.

    Metrics are over rows with label and score; ``n_unscored`` counts the labelled rows
    of the group that have no score.
    """
    y, p = F.col("_y"), F.col("_p")
    said, was = p >= threshold, y == 1
    clipped = F.greatest(F.lit(LOG_CLIP), F.least(F.lit(1.0 - LOG_CLIP), p))
    parts = {
        "sq": F.pow(p - y, F.lit(2.0)),
        "ll": -F.when(was, F.log(clipped)).otherwise(F.log(1.0 - clipped)),
        "tn": flag(~said & ~was),
        "fp": flag(said & ~was),
        "fn": flag(~said & was),
        "tp": flag(said & was),
    }
    n, pos = F.sum(F.col("pos") + F.col("neg")), F.sum("pos")
    out = ranked(df, label, score, keys, digits, parts).groupBy(*keys).agg(
        n.alias("n"),
        auc_expr().alias("auc"),
        (auc_expr() * 2 - 1).alias("gini"),
        ks_expr().alias("ks"),
        average_precision_expr().alias("average_precision"),
        (F.sum("sq") / n).alias("brier"),
        (pos / n * (1 - pos / n)).alias("brier_base_rate"),
        (F.sum("ll") / n).alias("log_loss"),
        ((F.sum("fp") * fp_cost + F.sum("fn") * fn_cost) / n).alias("expected_loss"),
        *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")],
    )
    missing = F.count_if(F.col(label).isNotNull() & F.col(score).isNull()).alias("n_unscored")
    unscored = df.groupBy(*keys).agg(missing)
    scored = out.where(F.col("n") > 0)
    if keys:
        return lookup_join(scored, unscored, list(keys))
    return scored.withColumn("n_unscored", unscored.scalar())


def roc_points(df: DataFrame, label="label", score="score", keys: Sequence[str] = (), digits=None):
    """(threshold, fpr, tpr) at every distinct score, ``score >= threshold`` positive."""
    threshold = F.col("_score") if digits is None else F.col("_score") / float(10**digits)
    return ranked(df, label, score, keys, digits).select(
        *keys,
        threshold.alias("threshold"),
        F.try_divide(
            (F.col("total_neg") - F.col("before_neg")).cast("double"),
            F.col("total_neg").cast("double"),
        ).alias("fpr"),
        F.try_divide(
            (F.col("total_pos") - F.col("before_pos")).cast("double"),
            F.col("total_pos").cast("double"),
        ).alias("tpr"),
    )


def reliability(
    df: DataFrame, label="label", score="score", bins: int = 10, keys: Sequence[str] = ()
) -> DataFrame:
    """Mean score and share of positives per uniform bin; empty bins do not appear."""
    return (
        df.withColumn("bin", left_open_bin(F.col(score), bins))
        .groupBy(*keys, "bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(score).alias("mean_score"),
            F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        )
    )


def best_threshold(
    df: DataFrame,
    label="label",
    score="score",
    fp_cost: float = 1.0,
    fn_cost: float = 5.0,
    keys: Sequence[str] = (),
    digits: int | None = 6,
) -> DataFrame:
    """Threshold with the smallest expected loss; the lowest one on a tie."""
    threshold = F.col("_score") if digits is None else F.col("_score") / float(10**digits)
    n = (F.col("total_pos") + F.col("total_neg")).cast("double")
    fp = F.col("total_neg") - F.col("before_neg")
    loss = (fp * fp_cost + F.col("before_pos") * fn_cost) / n
    best = F.min(F.struct(loss.alias("expected_loss"), threshold.alias("threshold")))
    picked = ranked(df, label, score, keys, digits).groupBy(*keys).agg(best.alias("_best"))
    return picked.select(*keys, "_best.threshold", "_best.expected_loss")


def method_table(df: DataFrame, label="label", score="score", method="method") -> DataFrame:
    """AUC, Brier, mean and spread per scoring method of a tall table."""
    ranks = ranked(df, label, score, [method]).groupBy(method).agg(auc_expr().alias("auc"))
    plain = df.groupBy(method).agg(
        brier_expr(label, score).alias("brier"),
        F.avg(score).alias("mean_score"),
        F.stddev_pop(score).alias("std_score"),
    )
    return plain.join(ranks, method)
