"""Category encoders: fit on training rows, map stored as a tall table.

Fitted maps are Spark tables (one row per column and category), never a driver
dictionary, so a column with many categories stays distributed. They are kept as
Parquet, whose known size lets Spark choose between broadcast and shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import string_columns
from riskloom.plans.joins import lookup_join
from riskloom.plans.lineage import checkpointed, stored
from riskloom.plans.shape import summarise, tall

# Codes of unseen and missing categories, smoothing defaults.
UNSEEN_CODE, MISSING_CODE = -1, -2
BAYES_M = 10.0
SIGMOID_SMOOTHING, NOISE_SHARE = 10.0, 0.01
HIGH_CARDINALITY = 5


def ranks_in_order(values: DataFrame, group: str, value: str) -> DataFrame:
    """0-based rank of each distinct value within its group, in value order.

    The rows are range-sorted and frozen on shared storage together with their row
    ids; a row's rank is its position in the sorted partition plus what earlier
    partitions hold of the group. No group is ever pulled into one task.
    """
    ordered = values.orderBy(group, value).withColumn("_id", F.monotonically_increasing_id())
    frozen = checkpointed(ordered).withColumn("_part", F.shiftright("_id", 33))
    parts = frozen.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")
    )
    earlier = Window.partitionBy(group).orderBy("_part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        group, "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    # one row per sorted partition and column: bounded by the partition count
    placed = frozen.join(F.broadcast(offsets), [group, "_part"])
    rank = F.col("_id") - F.col("_first") + F.col("_before")
    return placed.select(group, value, rank.cast("int").alias("code"))


def _map_columns(
    df: DataFrame, mapping: DataFrame, columns: Sequence[str], payload: str
) -> DataFrame:
    """Add ``_m_<column>`` = the payload found for each column's category."""
    for c in columns:
        one = mapping.where(F.col("feature") == c).select(
            F.col("category").alias(c), F.col(payload).alias(f"_m_{c}")
        )
        df = lookup_join(df, one, [c])
    return df


def _replace(df: DataFrame, columns: Sequence[str], new: dict[str, Column]) -> DataFrame:
    return df.select([new[c].alias(c) if c in columns else F.col(c) for c in df.columns
                      if not c.startswith("_m_")])


@dataclass
class OrdinalModel:
    columns: list[str]
    mapping: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """Codes in place of the string columns: missing -2, unseen -1."""
        present = [c for c in self.columns if c in df.columns]
        joined = _map_columns(df, self.mapping, present, "code")
        coded = {
            c: F.when(F.col(c).isNull(), F.lit(MISSING_CODE)).otherwise(
                F.coalesce(F.col(f"_m_{c}"), F.lit(UNSEEN_CODE))
            )
            for c in present
        }
        return _replace(joined, present, coded)


class OrdinalEncoder:
    """Codes every string column by the rank of the category in sorted order."""

    def __init__(self, columns: Sequence[str] | None = None) -> None:
        self.columns = columns

    def fit(self, df: DataFrame) -> OrdinalModel:
        columns = list(self.columns if self.columns is not None else string_columns(df))
        if not columns:
            empty = df.sparkSession.createDataFrame([], "feature string, category string, code int")
            return OrdinalModel([], empty)
        seen = tall(df, columns, (), "feature", "category", "string")
        distinct = seen.where(F.col("category").isNotNull()).distinct()
        return OrdinalModel(
            columns, stored(ranks_in_order(distinct, "feature", "category"), "encoding")
        )


def bayes_mean(n: Column, total: Column, prior: Column, m: float) -> Column:
    """(sum + m * prior) / (n + m); the prior where the category is empty."""
    return (total + prior * m) / (n + m)


def sigmoid_mean(n: Column, total: Column, prior: Column, smoothing: float) -> Column:
    weight = 1.0 / (1.0 + F.exp(-(n - 1.0) / smoothing))
    return F.when(n > 0, weight * F.try_divide(total, n) + (1.0 - weight) * prior).otherwise(prior)


@dataclass
class TargetModel:
    columns: list[str]
    mapping: DataFrame
    prior: float
    handle_unknown: str = "global_mean"
    noise: float = 0.0

    def transform(self, df: DataFrame, add_noise: bool = False, seed: int = 42) -> DataFrame:
        present = [c for c in self.columns if c in df.columns]
        joined = _map_columns(df, self.mapping, present, "encoded")
        default = 0.0 if self.handle_unknown == "zero" else self.prior
        coded = {}
        for i, c in enumerate(present):
            value = F.coalesce(F.col(f"_m_{c}"), F.lit(default))
            if add_noise and self.noise > 0:
                value = value + F.randn(seed + i) * (self.noise * self.prior)
            coded[c] = value
        return _replace(joined, present, coded)

    def category_counts(self) -> DataFrame:
        return self.mapping.groupBy("feature").agg(F.count(F.lit(1)).alias("n_categories"))


class TargetEncoder:
    """Smoothed target mean per category.

    ``method="bayes"`` pulls by a pseudo-count ``m``; ``method="sigmoid"`` blends by
    a sigmoid of the category size and can add noise on the training side.
    """

    def __init__(
        self,
        columns: Sequence[str] | None = None,
        method: str = "bayes",
        m: float = BAYES_M,
        smoothing: float = SIGMOID_SMOOTHING,
        noise: float = NOISE_SHARE,
        handle_unknown: str = "global_mean",
    ) -> None:
        if method not in ("bayes", "sigmoid"):
            raise ValueError(f"Unknown smoothing method: {method}")
        self.columns, self.method, self.handle_unknown = columns, method, handle_unknown
        self.m, self.smoothing, self.noise = m, smoothing, noise

    def encoded(self, n: Column, total: Column, prior: Column) -> Column:
        if self.method == "bayes":
            return bayes_mean(n, total, prior, self.m)
        return sigmoid_mean(n, total, prior, self.smoothing)

    def fit(self, df: DataFrame, target: str) -> TargetModel:
        columns = list(self.columns if self.columns is not None else string_columns(df))
        row = df.agg(F.avg(F.col(target).cast("double"))).first()
        prior = float(row[0]) if row and row[0] is not None else 0.0
        sums = _category_sums(df, columns, target, ())
        value = self.encoded(F.col("n"), F.col("total"), F.lit(prior))
        mapping = stored(sums.select("feature", "category", value.alias("encoded")), "encoding")
        return TargetModel(columns, mapping, prior, self.handle_unknown, self.noise)

    def fold_safe(self, df: DataFrame, target: str, fold: str = "fold") -> DataFrame:
        """Encode every row from the rows of the other folds only, all folds in one job.

        Adds ``<column>_te``. Per (category, fold) sums leave out the own fold by
        subtraction, so no fold is scanned twice.
        """
        columns = list(self.columns if self.columns is not None else string_columns(df))
        y = F.col(target).cast("double")
        everywhere = Window.partitionBy(F.lit(0))
        # one row per fold: the window holds k rows
        priors = df.groupBy(fold).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
        priors = priors.select(
            F.col(fold),
            F.try_divide(
                F.sum("_s").over(everywhere) - F.col("_s"),
                (F.sum("_n").over(everywhere) - F.col("_n")).cast("double"),
            ).alias("_prior"),
        )
        sums = _category_sums(df, columns, target, (fold,))
        # at most one row per fold in each (column, category) window
        whole = Window.partitionBy("feature", "category")
        others = sums.select(
            "feature",
            "category",
            fold,
            (F.sum("n").over(whole) - F.col("n")).alias("n"),
            (F.sum("total").over(whole) - F.col("total")).alias("total"),
        ).join(F.broadcast(priors), fold)
        mapping = stored(
            others.select(
                "feature",
                "category",
                fold,
                self.encoded(F.col("n"), F.col("total"), F.col("_prior")).alias("encoded"),
            ),
            "encoding",
        )
        out = df.join(F.broadcast(priors), fold, "left")
        for c in columns:
            one = mapping.where(F.col("feature") == c).select(
                F.col("category").alias(c), fold, F.col("encoded").alias(f"{c}_te")
            )
            out = lookup_join(out, one, [c, fold])
        filled = {f"{c}_te": F.coalesce(F.col(f"{c}_te"), F.col("_prior")) for c in columns}
        return out.withColumns(filled).drop("_prior")


def _category_sums(
    df: DataFrame, columns: Sequence[str], target: str, extra: Sequence[str]
) -> DataFrame:
    rows = df.withColumn("_y", F.col(target).cast("double"))
    long = tall(rows, columns, [*extra, "_y"], "feature", "category", "string")
    return (
        long.where(F.col("category").isNotNull())
        .groupBy("feature", "category", *extra)
        .agg(F.count("_y").cast("double").alias("n"), F.sum("_y").alias("total"))
    )


def category_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct categories per string column and whether target encoding pays off."""
    names = list(columns if columns is not None else string_columns(df))
    counts = summarise(
        df, names, {"n_categories": ("bigint", lambda c: f"count(DISTINCT {c})")}
    )
    return counts.withColumn("high_cardinality", F.col("n_categories") > HIGH_CARDINALITY)
