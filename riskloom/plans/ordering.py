"""Exact order statistics without a global sort in one task.

Rank statistics (AUC, KS, ROC points, percentiles) need totals over all smaller
values. The rows are first reduced to one row per distinct value (map-side
combine), then cut into value buckets of about equal depth; a window runs inside
each bucket and the small table of bucket totals supplies the offsets. A value
shared by a third of all rows is one row after the first step, and no bucket
holds more than its share of the distinct values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 200_000
SAMPLE_PER_BUCKET = 1_000
GRID_STEP = 1_000


def _bucketizer(df: DataFrame, value: str) -> Bucketizer:
    """Value cuts into buckets of about ``ROWS_PER_BUCKET`` rows, as many as the rows ask for.

    The cuts only balance the buckets, any cuts give the same totals; so they come
    from a sample, as Spark's own range partitioning does.
    """
    rows = df.count()
    wanted = rows // ROWS_PER_BUCKET
    cuts: list[float] = []
    if wanted > 1:
        known = df.select(F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull())
        sampled = known.sample(min(1.0, wanted * SAMPLE_PER_BUCKET / rows), seed=7)
        probabilities = [i / wanted for i in range(1, wanted)]
        cuts = sorted(set(sampled.approxQuantile(value, probabilities, 1.0 / (4 * wanted))))
    # Bucketizer wants three splits at least
    splits = [float("-inf"), *(cuts or [0.0]), float("inf")]
    return Bucketizer(
        splits=splits, inputCol=value, outputCol="_bucket", handleInvalid="keep"
    )


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str, sums: Mapping[str, Column]
) -> DataFrame:
    """One row per distinct (keys, known value) with the sums, which must be known and
    not negative."""
    known = df.where(F.col(value).isNotNull())
    counted = known.groupBy(*keys, value).agg(*[F.sum(c).alias(s) for s, c in sums.items()])
    # Always true, but it makes every later branch ask for all sums: their exchanges stay
    # identical, so Spark scans and shuffles once and reuses the result in each branch.
    return counted.where(reduce(add, [F.col(s) for s in sums]) >= 0)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sums: Mapping[str, Column],
    grid: bool = False,
) -> DataFrame:
    """:func:`value_counts` with, for each sum ``s``, ``before_s`` (over all smaller
    values of the same keys) and ``total_s`` (over all values).

    ``grid=True`` promises that ``value`` is a long on a bounded grid; its buckets
    are then plain intervals and no pass over the data is needed to cut them.
    """
    return totals_of_counts(value_counts(df, keys, value, sums), keys, value, list(sums), grid)


def totals_of_counts(
    counted: DataFrame, keys: Sequence[str], value: str, sums: Sequence[str], grid: bool = False
) -> DataFrame:
    """:func:`running_totals` of a table that already has one row per (keys, value). It is read
    several times."""
    if grid:
        cut = counted.withColumn("_bucket", F.floor(F.col(value) / F.lit(GRID_STEP)).cast("int"))
    else:
        cut = _bucketizer(counted, value).transform(counted)
        cut = cut.withColumn("_bucket", F.col("_bucket").cast("int"))

    # the keys as one struct: equal also where a key is NULL, and the windows inside the
    # buckets and the join to the offsets then share one partitioning
    cut = cut.withColumn("_g", F.struct(*keys) if keys else F.lit(0))
    inside = Window.partitionBy("_g", "_bucket").orderBy(value)
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select(
        "*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_in_{s}") for s in sums]
    )
    per_bucket = cut.groupBy("_g", "_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    # a row per bucket of a key (or interval of the grid)
    whole = Window.partitionBy("_g")
    across = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "_g",
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{s}").over(across), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"total_{s}") for s in sums],
    )
    return local.join(offsets, ["_g", "_bucket"]).select(
        *keys,
        value,
        *sums,
        *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"before_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )


def percentile_aggs(value: str, probabilities: Mapping[str, float], n: str = "n") -> list[Column]:
    """Aggregates picking the two neighbours and the weight of each percentile out of
    running totals of ``n``; :func:`percentile_column` puts them together."""
    first, after = f"`before_{n}`", f"(`before_{n}` + `{n}`)"
    aggs = []
    for name, q in probabilities.items():
        rank = f"((`total_{n}` - 1) * {float(q)!r}D)"
        for tag, at in (("lo", f"floor({rank})"), ("hi", f"ceil({rank})")):
            inside = f"{first} <= {at} AND {at} < {after}"
            aggs.append(F.expr(f"max(`{value}`) FILTER (WHERE {inside}) AS `_{tag}_{name}`"))
        aggs.append(F.expr(f"max({rank} - floor({rank})) AS `_w_{name}`"))
    return aggs


def percentile_sql(name: str) -> str:
    """Linear interpolation between the neighbours picked by :func:`percentile_aggs`."""
    return f"`_lo_{name}` + (`_hi_{name}` - `_lo_{name}`) * `_w_{name}`"


def percentiles_of(
    totals: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """Linearly interpolated percentiles from ``running_totals(..., {"n": ...})``."""
    picked = totals.groupBy(*keys).agg(*percentile_aggs(value, probabilities))
    return picked.selectExpr(
        *[f"`{k}`" for k in keys], *[f"{percentile_sql(n)} AS `{n}`" for n in probabilities]
    )


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    exact: bool = True,
) -> DataFrame:
    """Percentiles per key; ``exact=False`` uses Spark's bounded sketch instead."""
    if not exact:
        return df.groupBy(*keys).agg(
            *[F.percentile_approx(value, float(q)).alias(n) for n, q in probabilities.items()]
        )
    return percentiles_of(
        running_totals(df, keys, value, {"n": F.lit(1)}), keys, value, probabilities
    )
