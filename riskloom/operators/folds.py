"""Fold and split assignment as a column.

Exact strata need each row's rank within its class. A class can hold most rows, so
the rank is not a window over the class: rows are cut into buckets of the order key
and ranked inside a bucket, then shifted by the rows of earlier buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_INTERVAL = 100_000
# Fixed value: share of rows kept aside when no size is given.
TEST_SHARE = 0.5


def _hash_bucket(order: Column, intervals: int) -> Column:
    """Interval number of a 64-bit hash, in hash order."""
    width = 2.0**64 / intervals
    return F.floor((order.cast("double") + 2.0**63) / width).cast("int")


def rank_in_class(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """Add ``_rank`` (0-based, per label) and ``_size`` in the order of a seeded hash.

    The rows are counted first, so an interval holds about ``ROWS_PER_INTERVAL`` of them.
    """
    rows = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    intervals = df.count() // ROWS_PER_INTERVAL + 1
    rows = rows.withColumns({"_b": _hash_bucket(F.col("_h"), intervals), "_g": F.struct(label)})
    counts = rows.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n"))
    # a row per interval of a class
    whole = Window.partitionBy("_g")
    offsets = counts.select(
        "_g",
        "_b",
        (F.sum("_n").over(whole.orderBy("_b")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("_size"),
    )
    # the struct also matches a NULL label; rank and join share one partitioning
    inside = Window.partitionBy("_g", "_b").orderBy("_h", key)
    local = rows.withColumn("_in", F.row_number().over(inside) - 1)
    return local.join(offsets, ["_g", "_b"]).select(
        *df.columns, (F.col("_in") + F.col("_before")).alias("_rank"), "_size"
    )


def stratified_folds(
    df: DataFrame,
    key: str,
    label: str,
    k: int = 5,
    seed: int = 42,
    exact: bool = True,
    name: str = "fold",
) -> DataFrame:
    """Add a fold number; every fold holds the classes in equal parts.

    ``exact=False`` takes the seeded hash modulo k: strata are only close to equal
    but nothing is shuffled.
    """
    if not exact:
        return df.withColumn(name, F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(k)).cast("int"))
    ranked = rank_in_class(df, key, label, seed)
    return ranked.withColumn(name, F.pmod("_rank", F.lit(k)).cast("int")).drop("_rank", "_size")


def key_ordered_folds(df: DataFrame, key: str, k: int, name: str = "fold") -> DataFrame:
    """Folds from the key itself: reproducible outside Spark."""
    return df.withColumn(name, F.pmod(F.col(key), F.lit(k)).cast("int"))


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_share: float = TEST_SHARE,
    seed: int = 42,
    name: str = "is_eval",
) -> DataFrame:
    """Add a flag marking ``test_share`` of each class for evaluation.

    A class with fewer than two rows cannot be split; then the whole table is split
    without strata.
    """
    smallest = df.groupBy(label).count().agg(F.min("count")).first()
    if smallest is None or smallest[0] is None or smallest[0] < 2:
        return df.withColumn(
            name, F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000)) < test_share * 10_000
        )
    ranked = rank_in_class(df, key, label, seed)
    cut = F.floor(F.col("_size") * test_share)
    return ranked.withColumn(name, F.col("_rank") < cut).drop("_rank", "_size")
