"""Distribution shift between a reference and a current table.

Both tables are unpivoted once and reduced to one row per (feature, distinct
value) with counts per side. Running totals over those rows give the percentile
edges, the histograms and the KS distance of every feature in one job; nothing
loops over features and no raw column is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import band_below, flag, numeric_columns
from riskloom.plans.ordering import (
    percentile_aggs,
    percentile_sql,
    running_totals,
    value_counts,
)
from riskloom.plans.shape import rounded, summarise, tall

# Null bin, smoothing, bands and alert limits.
NULL_BIN = -999.0
EPSILON = 1e-6
EDGE_PAD = 1e-10
PSI_BANDS = ((0.10, "stable"), (0.20, "moderate"))
PSI_MAJOR = "major"
PSI_WARN, PSI_ALERT = 0.10, 0.20
PSI_FLAG, KS_FLAG = 0.1, 0.2
P_VALUE_FLAG = 0.05
KOLMOGOROV_TERMS = 100


def psi_label(psi: Column) -> Column:
    return band_below(psi, PSI_BANDS, PSI_MAJOR)


def common_numeric(reference: DataFrame, current: DataFrame) -> list[str]:
    """Sorted numeric columns both tables carry (metadata only)."""
    return sorted(set(numeric_columns(reference)) & set(numeric_columns(current)))


def null_rates(
    reference: DataFrame, current: DataFrame, features: Sequence[str]
) -> DataFrame:
    """Null share per feature on both sides and its absolute shift."""
    share = {"rate": ("double", lambda c: f"avg(CAST({c} IS NULL AS DOUBLE))")}
    ref = summarise(reference, features, share).withColumnRenamed("rate", "ref_null_rate")
    cur = summarise(current, features, share).withColumnRenamed("rate", "cur_null_rate")
    shift = F.abs(F.col("cur_null_rate") - F.col("ref_null_rate"))
    # one row per feature on both sides: the size is that of the schema
    return ref.join(F.broadcast(cur), "feature").withColumn("null_shift", shift)


@dataclass(frozen=True)
class SideBySide:
    """Both tables per (feature, distinct value): counts ``ref``/``cur`` and, among them,
    the missing values ``ref_null``/``cur_null``; ``totals`` adds the running totals."""

    counts: DataFrame
    totals: DataFrame


def side_by_side(
    reference: DataFrame, current: DataFrame, features: Sequence[str], null_as: float | None
) -> SideBySide:
    both = tall(reference, features).withColumn("_r", F.lit(True)).unionByName(
        tall(current, features).withColumn("_r", F.lit(False))
    )
    rows = both.select(
        "feature",
        (F.coalesce("value", F.lit(null_as)) if null_as is not None else F.col("value")).alias(
            "value"
        ),
        flag(F.col("_r")).alias("_ref"),
        flag(~F.col("_r")).alias("_cur"),
        flag(F.col("value").isNull()).alias("_null"),
    )
    sums = {
        "ref": F.col("_ref"),
        "cur": F.col("_cur"),
        "ref_null": F.col("_ref") * F.col("_null"),
        "cur_null": F.col("_cur") * F.col("_null"),
    }
    by = (rows, ["feature"], "value", sums)
    return SideBySide(value_counts(*by), running_totals(*by))


KS_SQL = """max(abs(
  try_divide(CAST(before_ref + ref AS DOUBLE), CAST(total_ref AS DOUBLE))
  - try_divide(CAST(before_cur + cur AS DOUBLE), CAST(total_cur AS DOUBLE))))"""

# linspace(lo, hi + pad, d + 1) over the d distinct reference values
UNIFORM_SQL = f"""transform(sequence(0L, d), i -> CASE WHEN i = d THEN hi + {EDGE_PAD!r}D
  ELSE lo + i * ((hi + {EDGE_PAD!r}D - lo) / d) END)"""


def feature_summary(both: SideBySide, n_bins: int = 10) -> DataFrame:
    """Everything read off the running totals in one aggregate, one row per feature.

    ``quantile_edges`` are the reference percentiles; ``edges`` the same unless the
    reference has fewer than ``n_bins`` distinct values, then uniform ones.
    """
    names = {f"e{i}": i / n_bins for i in range(n_bins + 1)}
    out = both.totals.groupBy("feature").agg(
        *percentile_aggs("value", names, "ref"),
        F.expr("count_if(ref > 0) AS d"),
        F.expr("min(value) FILTER (WHERE ref > 0) AS lo"),
        F.expr("max(value) FILTER (WHERE ref > 0) AS hi"),
        F.expr(f"{KS_SQL} AS ks"),
        F.expr("sum(ref) AS ref_total"),
        F.expr("sum(cur) AS cur_total"),
        F.expr("sum(ref_null) AS ref_nulls"),
        F.expr("sum(cur_null) AS cur_nulls"),
    )
    quantiles = "array(" + ", ".join(percentile_sql(n) for n in names) + ")"
    return out.selectExpr(
        "feature",
        f"{quantiles} AS quantile_edges",
        f"CASE WHEN d > 0 AND d < {n_bins} THEN {UNIFORM_SQL} ELSE {quantiles} END AS edges",
        "d",
        "lo",
        "hi",
        "ks",
        "ref_total",
        "cur_total",
        "try_divide(CAST(ref_nulls AS DOUBLE), CAST(ref_total AS DOUBLE)) AS ref_null_rate",
        "try_divide(CAST(cur_nulls AS DOUBLE), CAST(cur_total AS DOUBLE)) AS cur_null_rate",
    )


def known_edges(summary: DataFrame) -> DataFrame:
    """The summary with distinct percentile edges in place of ``edges``."""
    return summary.withColumn("edges", F.array_sort(F.array_distinct("quantile_edges")))


def bin_counts(both: SideBySide, summary: DataFrame, max_bins: int = 10) -> DataFrame:
    """The summary with ``ref_n`` and ``cur_n`` per bin and the current values outside.

    Bins are half-open, the last one closed. A count is the difference of two counts
    of smaller values, so repeated edges give empty bins and values outside the edges
    are not counted.
    """
    below = [
        f"coalesce(sum({side}) FILTER (WHERE value < _e[{i}]"
        f" OR ({i} = size(edges) - 1 AND value = _e[{i}])), 0) AS {side}{i}"
        for side in ("ref", "cur")
        for i in range(max_bins + 1)
    ]
    outside = "coalesce(sum(cur) FILTER (WHERE value < lo OR value > hi), 0) AS n_outside"
    # a few numbers per feature: the size of the summary is that of the schema
    fixed = f"transform(sequence(0, {max_bins}), i -> get(edges, i))"
    padded = summary.withColumn("_e", F.expr(fixed))
    rows = both.counts.join(F.broadcast(padded), "feature")
    counted = rows.groupBy(*summary.columns).agg(*[F.expr(b) for b in below], F.expr(outside))

    def bins(side: str) -> str:
        steps = ", ".join(f"{side}{i + 1} - {side}{i}" for i in range(max_bins))
        return f"slice(array({steps}), 1, greatest(size(edges) - 1, 0)) AS {side}_n"

    return counted.selectExpr(*summary.columns, bins("ref"), bins("cur"), "n_outside")


def histograms(counts: DataFrame) -> DataFrame:
    """(feature, bin, ref_n, cur_n) of packed bin counts."""
    return counts.selectExpr(
        "feature",
        "inline(transform(ref_n, (n, i) -> struct(i AS bin, n AS ref_n, cur_n[i] AS cur_n)))",
    )


# Smoothing added to the counts before they become shares of the counted values.
PSI_COUNTS_SQL = f"""aggregate(
  transform(ref_n, (n, i) -> struct(
    (n + {EPSILON!r}D) / aggregate(ref_n, 0D, (a, x) -> a + x + {EPSILON!r}D) AS r,
    (cur_n[i] + {EPSILON!r}D) / aggregate(cur_n, 0D, (a, x) -> a + x + {EPSILON!r}D) AS c)),
  0D, (a, t) -> a + (t.c - t.r) * ln(t.c / t.r))"""

# Smoothing added to the shares of all known values.
PSI_SHARES_SQL = f"""aggregate(
  transform(ref_n, (n, i) -> struct(
    try_divide(n, ref_total) + {EPSILON!r}D AS r,
    try_divide(cur_n[i], cur_total) + {EPSILON!r}D AS c)),
  0D, (a, t) -> a + (t.c - t.r) * ln(t.c / t.r))"""


def psi(
    reference: DataFrame, current: DataFrame, features: Sequence[str], n_bins: int = 10
) -> DataFrame:
    """Null-aware PSI per feature: missing values form their own bin."""
    both = side_by_side(reference, current, features, NULL_BIN)
    counts = bin_counts(both, feature_summary(both, n_bins), n_bins)
    return counts.selectExpr("feature", f"{PSI_COUNTS_SQL} AS psi")


def psi_known_values(
    reference: DataFrame, current: DataFrame, features: Sequence[str], n_bins: int = 10
) -> DataFrame:
    """PSI over the known values only, on distinct percentile edges."""
    both = side_by_side(reference, current, features, None)
    counts = bin_counts(both, known_edges(feature_summary(both, n_bins)), n_bins)
    return counts.selectExpr("feature", f"{PSI_SHARES_SQL} AS psi")


def ks_drift(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Two-sample KS distance per feature, missing values as one point."""
    both = side_by_side(reference, current, features, NULL_BIN)
    return both.totals.groupBy("feature").agg(F.expr(f"{KS_SQL} AS ks"))


def kolmogorov_p(distance: Column, n_ref: Column, n_cur: Column) -> Column:
    """Asymptotic two-sided p-value of the KS distance."""
    size = F.sqrt(n_ref.cast("double") * n_cur / (n_ref + n_cur))
    x = size * distance
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KOLMOGOROV_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * k * k * x * x),
    )
    # the series only converges away from zero, where the p-value is one anyway
    return F.when(x < 0.2, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))
    )


def ks_test(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """KS distance of the known values with its p-value and a drift flag."""
    present = [f for f in features if f in current.columns]
    both = side_by_side(reference, current, present, None)
    out = both.totals.groupBy("feature").agg(
        F.expr(f"{KS_SQL} AS ks"), F.sum("ref").alias("_n"), F.sum("cur").alias("_m")
    )
    p = kolmogorov_p(F.col("ks"), F.col("_n"), F.col("_m"))
    return out.select("feature", "ks", p.alias("p_value")).withColumn(
        "drifted", F.col("p_value") < P_VALUE_FLAG
    )


EMPTY_REPORT = (
    "feature string, psi double, ks double, ref_null_rate double, cur_null_rate double,"
    " null_shift double, n_outside long, drifted boolean"
)


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    n_bins: int = 10,
    psi_limit: float = PSI_FLAG,
    ks_limit: float = KS_FLAG,
) -> DataFrame:
    """PSI, KS and null-rate shift of every common numeric column, worst PSI first."""
    features = common_numeric(reference, current)
    if not features:
        return reference.sparkSession.createDataFrame([], EMPTY_REPORT)
    both = side_by_side(reference, current, features, NULL_BIN)
    counts = bin_counts(both, feature_summary(both, n_bins), n_bins)
    exact = counts.selectExpr(
        "feature",
        f"{PSI_COUNTS_SQL} AS psi",
        "ks",
        "ref_null_rate",
        "cur_null_rate",
        "abs(cur_null_rate - ref_null_rate) AS null_shift",
        "n_outside",
    )
    drifted = (F.col("psi") > psi_limit) | (F.col("ks") > ks_limit)
    return rounded(exact.withColumn("drifted", drifted)).orderBy(F.col("psi").desc(), "feature")


def drift_summary(report: DataFrame) -> DataFrame:
    """Totals of a drift report: features checked, drifted, and which."""
    names = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))
    return report.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if("drifted").alias("n_drifted"),
        F.array_join(names, ",").alias("drifted_features"),
    )


# -- batch monitor ----------------------------------------------------------------


def check_batch(
    reference: DataFrame,
    batch: DataFrame,
    features: Sequence[str],
    score: str,
    batch_label: str = "current",
    n_bins: int = 10,
) -> DataFrame:
    """Drift of a batch against the training data: one row per watched feature and
    one for the score, with PSI, KS, p-value, band, alert text and the batch's known values.

    A feature that the batch lacks, or that has no known value in it, is an ALERT.
    """
    watched = [score, *[f for f in features if f != score]]
    present = [f for f in watched if f in batch.columns]
    both = side_by_side(reference, batch, present, None)
    counts = bin_counts(both, known_edges(feature_summary(both, n_bins)), n_bins)
    p = kolmogorov_p(F.col("ks"), F.col("ref_total"), F.col("cur_total"))
    seen = counts.withColumns({"psi": F.expr(PSI_SHARES_SQL), "p_value": p})
    # one row per watched feature
    names = batch.sparkSession.createDataFrame([(f,) for f in watched], "feature string")
    out = names.join(seen, "feature", "left").withColumn(
        "n_samples", F.coalesce("cur_total", F.lit(0)).cast("long")
    )
    is_score = F.col("feature") == score
    lost = F.col("n_samples") == 0
    alert = F.when(lost | (F.col("psi") > PSI_ALERT), "ALERT").when(
        is_score & (F.col("psi") > PSI_WARN), "WARN"
    )
    return out.select(
        F.lit(batch_label).alias("batch_label"),
        "feature",
        is_score.alias("is_score"),
        F.round("psi", 5).alias("psi"),
        F.round("ks", 5).alias("ks"),
        F.when(~lost, F.round("p_value", 5)).alias("p_value"),
        F.when(lost, F.lit("no values")).otherwise(psi_label(F.col("psi"))).alias("status"),
        alert.alias("alert"),
        "n_samples",
    )


def reference_profile(reference: DataFrame, features: Sequence[str], n_bins: int = 10) -> DataFrame:
    """Frozen (feature, edges, ref counts, ref_total): enough to score later batches.

    A few numbers per feature, meant to be written once as Parquet.
    """
    both = side_by_side(reference, reference.where(F.lit(False)), features, None)
    counts = bin_counts(both, known_edges(feature_summary(both, n_bins)), n_bins)
    return counts.select("feature", "edges", F.col("ref_n").alias("ref_counts"), "ref_total")


def bin_of(value: Column, edges: Column) -> Column:
    """Bin number of a value over an edge array, NULL outside: last bin closed."""
    at = F.size(F.filter(edges, lambda e: e <= value)) - 1
    bins = F.size(edges) - 1
    top = (at == bins) & (value == F.element_at(edges, -1))
    return F.when(top, bins - 1).when((at >= 0) & (at < bins), at)


def psi_against_profile(counts: DataFrame, profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PSI of binned current counts ``(keys, feature, bin, n)`` against a profile.

    ``n`` with a NULL bin counts known values outside the edges. Bins the current
    side misses count as empty.
    """
    by = [*keys, "feature"]
    packed = counts.groupBy(*by).agg(
        F.sum("n").alias("cur_total"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))
        ).alias("_n"),
    )
    # the profile holds one row per watched feature: the size is that of the schema
    rows = packed.join(F.broadcast(profile), "feature")
    bins = F.sequence(F.lit(0), F.size("ref_counts") - 1)
    terms = F.transform(
        bins,
        lambda i: F.struct(
            (F.get("ref_counts", i) / F.col("ref_total") + EPSILON).alias("r"),
            (
                F.coalesce(F.try_element_at("_n", i), F.lit(0)) / F.col("cur_total") + EPSILON
            ).alias("c"),
        ),
    )
    value = F.aggregate(
        terms, F.lit(0.0), lambda acc, t: acc + (t["c"] - t["r"]) * F.log(t["c"] / t["r"])
    )
    out = rows.select(*by, "cur_total", value.alias("psi"))
    return out.withColumn("status", psi_label(F.col("psi")))
