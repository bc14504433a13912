"""Data profiling: distributions, missingness, target rates, correlations, histograms."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import numeric_columns
from riskloom.plans.joins import lookup_join
from riskloom.plans.ordering import percentiles
from riskloom.plans.shape import report_rows, summarise, tall

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
DIRECT_PAIRS = 30


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every category, missing values included."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("n") / total)


def describe(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    features = list(columns or numeric_columns(df))
    moments = summarise(
        df,
        features,
        {
            "count": ("bigint", lambda c: f"count({c})"),
            "mean": ("double", lambda c: f"avg({c})"),
            "std": ("double", lambda c: f"stddev_samp({c})"),
            "min": ("double", lambda c: f"min({c})"),
            "max": ("double", lambda c: f"max({c})"),
        },
    )
    quartiles = percentiles(tall(df, features), ["feature"], "value", QUARTILES, exact)
    # one row per column on both sides: the size is that of the schema
    return moments.join(F.broadcast(quartiles), "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def missing_report(df: DataFrame, top: int | None = None) -> DataFrame:
    """Missing count and percentage of the columns that miss any, most first."""
    kinds = {f"`{f.name}`": f.dataType.simpleString() for f in df.schema.fields}
    out = summarise(
        df,
        df.columns,
        {
            "missing_count": ("bigint", lambda c: f"count_if({c} IS NULL)"),
            "_n": ("bigint", lambda c: "count(1)"),
            "dtype": ("string", lambda c: f"first('{kinds[c]}')"),
        },
    )
    pct = F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("_n").cast("double")), 2)
    out = (
        out.where(F.col("missing_count") > 0)
        .withColumn("missing_pct", pct)
        .select("feature", "missing_count", "missing_pct", "dtype")
        .orderBy(F.col("missing_count").desc(), "feature")
    )
    return out.limit(top) if top is not None else out


def missing_vs_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Target rate (percent) where a column is missing and where it is present."""
    present = [c for c in columns if c in df.columns]
    rate = f"100 * avg(CAST(`{target}` AS DOUBLE)) FILTER (WHERE "
    out = summarise(
        df,
        present,
        {
            "rate_missing": ("double", lambda c: f"{rate}{c} IS NULL)"),
            "rate_present": ("double", lambda c: f"{rate}{c} IS NOT NULL)"),
        },
    )
    gap = F.col("rate_missing") - F.col("rate_present")
    return out.select(
        "feature",
        F.round("rate_missing", 2).alias("rate_missing"),
        F.round("rate_present", 2).alias("rate_present"),
        F.round(gap, 2).alias("difference"),
    ).orderBy(F.col("difference").desc_nulls_last(), "feature")


def sentinel_audit(df: DataFrame, column: str, sentinel: float, target: str) -> DataFrame:
    """Rows carrying the sentinel, their share, and the target rate in and out."""
    hit = F.col(column) == sentinel
    y = F.col(target).cast("double")
    return df.agg(
        F.count_if(hit).alias("n_sentinel"),
        F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("share"),
        F.avg(F.when(hit, y)).alias("rate_sentinel"),
        F.avg(F.when(hit, None).otherwise(y)).alias("rate_other"),
        F.min(column).cast("double").alias("min_value"),
    )


def target_rate_by_category(
    df: DataFrame, column: str, target: str, min_count: int = 100
) -> DataFrame:
    """Target rate per frequent enough category beside the overall rate, lowest first."""
    y = F.col(target).cast("double")
    overall = df.agg(F.avg(y)).scalar()
    out = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.avg(y).alias("target_rate"), F.count(y).alias("n"))
        .where(F.col("n") >= min_count)
    )
    return out.withColumn("overall_rate", overall).orderBy("target_rate", column)


# -- correlation --------------------------------------------------------------------


def _corr(n: Column, sx: Column, sy: Column, sxy: Column, sxx: Column, syy: Column) -> Column:
    """Pearson correlation from sums; NULL for a constant side."""
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    scale = F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vy, F.lit(0.0)))
    ok = (n > 1) & (vx > 1e-12 * F.abs(n * sxx)) & (vy > 1e-12 * F.abs(n * syy))
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (n * sxy - sx * sy) / scale))
    return F.when(ok, bounded)


MOMENTS = ("n", "sx", "sy", "sxy", "sxx", "syy")


def _pair_sums(a: str, b: str, tag: str) -> list[Column]:
    """Sums over the rows where both columns are known, named ``<moment>__<tag>``."""
    terms = ("1D", a, b, f"{a} * {b}", f"{a} * {a}", f"{b} * {b}")
    known = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    return [
        F.expr(f"sum({term}) {known} AS `{k}__{tag}`")
        for k, term in zip(MOMENTS, terms, strict=True)
    ]


def pair_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete sums per ordered column pair (a before b), values centred.

    Few pairs become one plain aggregate. Many pairs are summed as small matrices
    inside each task (its size depends on the number of columns only) and then by
    pair, which keeps the generated code small.
    """
    names = list(columns)
    centre = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    assert centre is not None
    middle = {c: float(centre[c]) if centre[c] is not None else 0.0 for c in names}
    x = df.select([(F.col(c).cast("double") - F.lit(middle[c])).alias(c) for c in names])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    if len(pairs) <= DIRECT_PAIRS:
        aggs, rows = [], []
        for i, j in pairs:
            a, b = f"`{names[i]}`", f"`{names[j]}`"
            aggs += _pair_sums(a, b, f"{i}_{j}")
            parts = ", ".join(f"`{k}__{i}_{j}` AS {k}" for k in MOMENTS)
            rows.append(f"struct('{names[i]}' AS a, '{names[j]}' AS b, {parts})")
        return x.agg(*aggs).selectExpr(f"inline(array({', '.join(rows)}))")

    upper = np.triu_indices(len(names), 1)
    left = np.asarray(names, dtype=object)[upper[0]]
    right = np.asarray(names, dtype=object)[upper[1]]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            raw = batch.to_numpy(dtype=float)
            known = (~np.isnan(raw)).astype(float)
            v = np.nan_to_num(raw)
            # entry [i, j]: n, sum of i, sum of j, product, squares of i, squares of j
            part = np.stack(
                [
                    known.T @ known,
                    v.T @ known,
                    known.T @ v,
                    v.T @ v,
                    (v * v).T @ known,
                    known.T @ (v * v),
                ]
            )
            total = part if total is None else total + part
        if total is not None:
            cells = total[:, upper[0], upper[1]]
            stats = dict(zip(MOMENTS, cells, strict=True))
            yield pd.DataFrame({"a": left, "b": right, **stats})

    parts = x.mapInPandas(partial, "a string, b string, " + ", ".join(f"{m} double" for m in MOMENTS))
    return parts.groupBy("a", "b").agg(*[F.sum(m).alias(m) for m in MOMENTS])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every column pair, pairwise complete."""
    sums = [F.col(m) for m in MOMENTS]
    return pair_moments(df, columns).select("a", "b", _corr(*sums).alias("corr"))


def correlation_with_target(
    df: DataFrame, columns: Sequence[str], target: str, top: int | None = None
) -> DataFrame:
    """Columns by absolute correlation with the target, strongest first."""
    names = [*columns, target]
    centre = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    assert centre is not None
    shifted = df.select(
        *[
            (F.col(c).cast("double") - F.lit(float(centre[c] or 0.0))).alias(f"_x{i}")
            for i, c in enumerate(columns)
        ],
        (F.col(target).cast("double") - F.lit(float(centre[target] or 0.0))).alias("_y"),
    )
    aggs = [e for i, c in enumerate(columns) for e in _pair_sums(f"_x{i}", "_y", c)]
    rows = report_rows(shifted.agg(*aggs), list(columns), {m: "double" for m in MOMENTS})
    out = rows.select("feature", _corr(*[F.col(m) for m in MOMENTS]).alias("corr")).orderBy(
        F.abs("corr").desc_nulls_last(), "feature"
    )
    return out.limit(top) if top is not None else out


# -- caps and histograms ---------------------------------------------------------------


def cap_at_percentile(
    df: DataFrame, column: str, group: str, q: float = 0.99, exact: bool = True
) -> DataFrame:
    """The rows with ``column`` capped at its percentile within the group."""
    known = df.where(F.col(column).isNotNull())
    caps = percentiles(known, [group], column, {"_cap": q}, exact)
    capped = lookup_join(df, caps, [group])
    value = F.when(F.col(column).isNotNull(), F.least(F.col(column), F.col("_cap")))
    return capped.withColumn(column, value).drop("_cap")


def histogram(df: DataFrame, column: str, bins: int, groups: Sequence[str] = ()) -> DataFrame:
    """Fixed-width bins over the whole range (top edge in the last bin), with density."""
    known = df.where(F.col(column).isNotNull())
    span = known.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    low, high = span["lo"].cast("double"), span["hi"].cast("double")
    width = (high - low) / bins
    place = F.floor(F.try_divide(F.col(column) - low, width))
    at = F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("int")
    counted = (
        known.withColumn("bin", at)
        .withColumns({"_low": low, "_width": width})
        .groupBy(*groups, "bin", "_low", "_width")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counted.groupBy(*groups).agg(F.sum("n").alias("_total"))
    if groups:
        counted = lookup_join(counted, totals, list(groups))
    else:
        counted = counted.withColumn("_total", known.agg(F.count(F.lit(1))).scalar())
    return counted.select(
        *groups,
        "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_low"),
        "n",
        F.try_divide(F.col("n").cast("double"), F.col("_total") * F.col("_width")).alias("density"),
    )
