"""Joins with the guarantees the feature tables need."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(on: Sequence[str], prefix: str) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in on]
    )


def lookup_join(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a table holding each key once; keys compare null-safe.

    One plain join for tables of any size and for streams: Spark broadcasts the table
    where its bytes allow and adaptive execution splits hot keys.
    """
    renamed = table.select(
        *[F.col(k).alias(f"_r_{k}") for k in on], *[c for c in table.columns if c not in on]
    )
    return df.join(renamed, _same(on, "_r_"), "left").drop(*[f"_r_{k}" for k in on])


def checked_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join that raises when the right side would multiply rows of the left."""
    copies = right.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    fan_out = left.select(key).distinct().join(
        copies.where(F.col("_copies") > 1).withColumnRenamed(key, "_k"),
        F.col(key).eqNullSafe(F.col("_k")),
        "left_semi",
    )
    if fan_out.limit(1).count():
        sizes = lookup_join(left.select(key), copies, [key]).agg(
            F.count(F.lit(1)), F.sum(F.coalesce("_copies", F.lit(1)))
        )
        before, after = sizes.first() or (0, 0)
        raise ValueError(
            f"{key} is not unique on the joined side: {before} -> {after} rows"
        )
    return lookup_join(left, right, [key])


def count_without_children(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """One row: parents, and how many of them have no child row."""
    seen = children.where(F.col(key).isNotNull()).select(key).distinct()
    marked = parents.select(key).join(seen.withColumn("_has", F.lit(True)), key, "left")
    return marked.agg(
        F.count(F.lit(1)).alias("n_parents"),
        F.count_if(F.col("_has").isNull()).alias("n_without_children"),
    )
