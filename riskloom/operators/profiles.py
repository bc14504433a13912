"""Frozen reference profiles and drift read from them.

A profile holds a few numbers per feature: PSI edges, cuts (percentiles and edges) and the
reference counts below each cut. It is made once, from exact percentiles or from mergeable
quantile sketches, and written as Parquet. A later table is counted between the cuts in one
pass: each value becomes the number of its interval inside the row, and the counts of an
interval are combined in each task before the shuffle, so no cell is shuffled and the
reference is not read again.

PSI is exact for the profile's edges. KS is read at the cuts: ``ks`` is never above the
distance of the two samples, ``ks_upper`` never below it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.drift import (
    EMPTY_REPORT,
    KS_FLAG,
    NULL_BIN,
    PSI_ALERT,
    PSI_COUNTS_SQL,
    PSI_FLAG,
    PSI_SHARES_SQL,
    PSI_WARN,
    UNIFORM_SQL,
    common_numeric,
    kolmogorov_p,
    psi_label,
)
from riskloom.plans.ordering import percentile_aggs, percentile_sql, running_totals
from riskloom.plans.shape import report_rows, rounded, tall

KNOTS = 100
SKETCH_K = 4_000
DISTINCT_ERROR = 0.01


def sketches(df: DataFrame, features: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """(feature, sketch, d) from one wide aggregate: a mergeable quantile sketch of the known
    values (NULL without any) and an estimate of their distinct number.

    Sketches of several tables merge by ``kll_merge_agg_double``.
    """
    aggs = []
    for f in features:
        value = F.col(f"`{f}`").cast("double")
        known = F.when(~F.isnan(value), value)
        aggs += [
            F.when(F.count(known) > 0, F.kll_sketch_agg_double(known, F.lit(k))).alias(f"sketch__{f}"),
            F.approx_count_distinct(known, DISTINCT_ERROR).alias(f"d__{f}"),
        ]
    return report_rows(df.agg(*aggs), features, {"sketch": "binary", "d": "bigint"})


def _sketched_knots(df: DataFrame, features: Sequence[str], k: int) -> DataFrame:
    ranks = [i / KNOTS for i in range(KNOTS + 1)]
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(r)) for r in ranks])
    return sketches(df, features, k).where("sketch IS NOT NULL").select("feature", quantiles.alias("knots"), "d")


def _exact_knots(df: DataFrame, features: Sequence[str]) -> DataFrame:
    names = {f"e{i}": i / KNOTS for i in range(KNOTS + 1)}
    totals = running_totals(tall(df, features).where("NOT isnan(value)"), ["feature"], "value", {"n": F.lit(1)})
    picked = totals.groupBy("feature").agg(*percentile_aggs("value", names), F.count(F.lit(1)).alias("d"))
    return picked.selectExpr("feature", f"array({', '.join(percentile_sql(n) for n in names)}) AS knots", "d")


def freeze(
    reference: DataFrame,
    features: Sequence[str],
    n_bins: int = 10,
    exact: bool = True,
    uniform: bool = False,
    null_as: float | None = None,
    k: int = SKETCH_K,
) -> DataFrame:
    """The profile of ``reference``: one row per feature with a known value.

    ``n_bins`` must divide 100. ``exact=False`` takes the percentiles from sketches of
    rank error about 2.3 / k ** 0.9; the counts between the cuts are exact either way.
    ``uniform`` gives features with fewer than ``n_bins`` distinct values uniform edges;
    ``null_as`` lets missing values take part in the percentiles as that value.
    """
    if KNOTS % n_bins:
        raise ValueError(f"n_bins must divide {KNOTS}")
    rows = reference
    if null_as is not None:
        rows = reference.select(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(null_as)).alias(f) for f in features])
    knots = _exact_knots(rows, features) if exact else _sketched_knots(rows, features, k)
    quantiles = F.array(*[F.get("knots", i * KNOTS // n_bins) for i in range(n_bins + 1)])
    ready = knots.select(
        "feature", "knots", "d", quantiles.alias("q"), F.get("knots", 0).alias("lo"), F.get("knots", KNOTS).alias("hi")
    )
    edges = F.expr(f"CASE WHEN d < {n_bins} THEN {UNIFORM_SQL} ELSE q END") if uniform else F.col("q")
    ready = ready.withColumn("edges", F.array_sort(F.array_distinct(edges)))
    cuts = F.array_sort(F.array_distinct(F.concat("knots", "edges")))
    table = ready.select("feature", "edges", cuts.alias("cuts"))
    # a row per feature: the size is that of the schema
    rows = table.collect()
    fixed = reference.sparkSession.createDataFrame(rows, table.schema)
    return fixed.join(counts_between(reference, {r.feature: r.cuts for r in rows}), "feature")


def counts_between(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """(feature, counts, n_null) with the known values below the first cut, in each interval
    between cuts (half-open, the last one closed) and above the last one.

    One scan; what is shuffled is a row per task, feature and interval.
    """
    spark = df.sparkSession
    names = [f for f in cuts if f in df.columns]
    if not names:
        return spark.createDataFrame([], "feature string, counts array<long>, n_null long")
    splits = [
        [-math.inf, *dict.fromkeys([cuts[f][0], *cuts[f][:-1]]), math.nextafter(cuts[f][-1], math.inf), math.inf] for f in names
    ]
    values = df.select(*[F.col(f"`{f}`").cast("double").alias(f"v{i}") for i, f in enumerate(names)])
    values = values.select(*[F.when(~F.isnan(v), F.col(v)).alias(v) for v in values.columns])
    bins = Bucketizer(
        inputCols=values.columns,
        outputCols=[f"b{i}" for i in range(len(names))],
        splitsArray=splits,
        handleInvalid="keep",
    ).transform(values)
    # "keep" gives nulls a bin of their own behind the others
    numbers = bins.select(
        *[F.when(F.col(f"v{i}").isNotNull(), F.col(f"b{i}")).cast("int").alias(f) for i, f in enumerate(names)]
    )
    counted = tall(numbers, names, dtype="int").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    held = counted.groupBy("feature").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("value", "n")))).alias("m"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
    )
    sizes = spark.createDataFrame([(f, len(s) - 1) for f, s in zip(names, splits)], "feature string, size int")
    filled = F.transform(
        F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))
    )
    out = sizes.join(held, "feature", "left")
    return out.select("feature", filled.alias("counts"), F.coalesce("n_null", F.lit(0)).alias("n_null"))


def _below(counts: str) -> str:
    """Running totals of the counts: values below each cut, up to the last one included."""
    return f"transform(sequence(1, size({counts}) - 1), i -> aggregate(slice({counts}, 1, i), 0L, (a, x) -> a + x))"


def _with_nulls(counts: str, nulls: str, null_as: float | None) -> str:
    """The counts with the missing values added to the interval of ``null_as``."""
    if null_as is None:
        return counts
    at = (
        f"CASE WHEN {null_as!r}D > element_at(cuts, -1) THEN size({counts}) - 1"
        f" WHEN {null_as!r}D = element_at(cuts, -1) THEN size({counts}) - 2"
        f" ELSE size(filter(cuts, c -> c <= {null_as!r}D)) END"
    )
    return f"transform({counts}, (n, i) -> n + CASE WHEN i = ({at}) THEN {nulls} ELSE 0L END)"


def compared(profile: DataFrame, current: DataFrame, null_as: float | None = None) -> DataFrame:
    """Profile and current counts side by side, one row per feature of the profile:
    ``ref_n`` and ``cur_n`` per PSI bin, totals, null rates, ``ks`` and ``ks_upper``.

    Only ``current`` is scanned; the profile's rows are read on the driver, as many as features.
    """
    cuts = {r.feature: r.cuts for r in profile.select("feature", "cuts").collect()}
    now = counts_between(current, cuts).select("feature", F.col("counts").alias("now"), F.col("n_null").alias("now_null"))
    both = profile.join(F.broadcast(now), "feature", "left")
    both = both.withColumns(
        {"now": F.coalesce("now", F.expr("transform(counts, c -> 0L)")), "now_null": F.coalesce("now_null", F.lit(0))}
    )
    both = both.withColumns(
        {
            "r": F.expr(_below(_with_nulls("counts", "n_null", null_as))),
            "c": F.expr(_below(_with_nulls("now", "now_null", null_as))),
            "ref_total": F.expr("aggregate(counts, 0L, (a, x) -> a + x)") + (0 if null_as is None else F.col("n_null")),
            "cur_total": F.expr("aggregate(now, 0L, (a, x) -> a + x)") + (0 if null_as is None else F.col("now_null")),
        }
    )
    both = both.withColumn("at", F.expr("transform(edges, e -> array_position(cuts, e) - 1)"))

    def per_bin(b: str) -> str:
        inside = f"transform(sequence(0, size(at) - 2), j -> {b}[CAST(at[j + 1] AS INT)] - {b}[CAST(at[j] AS INT)])"
        return f"CASE WHEN size(at) < 2 THEN CAST(array() AS ARRAY<BIGINT>) ELSE {inside} END"

    def shares_of(b: str, total: str) -> Column:
        return F.expr(f"concat(array(0D), transform({b}, x -> try_divide(x, {total})), array(1D))")

    shares = both.withColumns({"fr": shares_of("r", "ref_total"), "fc": shares_of("c", "cur_total")})
    ks = "array_max(zip_with(fr, fc, (x, y) -> abs(x - y)))"
    upper = (
        "array_max(transform(sequence(0, size(fr) - 2), i -> greatest(abs(fr[i + 1] - fc[i]), abs(fc[i + 1] - fr[i]))))"
    )
    known = "cur_total > 0 AND ref_total > 0"
    return shares.select(
        "feature",
        F.expr(per_bin("r")).alias("ref_n"),
        F.expr(per_bin("c")).alias("cur_n"),
        "ref_total",
        "cur_total",
        F.expr(f"CASE WHEN {known} THEN {ks} END").alias("ks"),
        F.expr(f"CASE WHEN {known} THEN {upper} END").alias("ks_upper"),
        F.expr("try_divide(n_null, n_null + aggregate(counts, 0L, (a, x) -> a + x))").alias("ref_null_rate"),
        F.expr("try_divide(now_null, now_null + aggregate(now, 0L, (a, x) -> a + x))").alias("cur_null_rate"),
        F.expr("c[0] + cur_total - element_at(c, -1)").alias("n_outside"),
    )


def check_batch_against(
    profile: DataFrame, batch: DataFrame, features: Sequence[str], score: str, batch_label: str = "current"
) -> DataFrame:
    """The batch monitor on a stored profile: the rows of :func:`drift.check_batch` and
    ``ks_upper``, with KS and p-value read at the profile's cuts. The reference is not read.

    A feature that the batch or the profile lacks, or without a known value, is an ALERT.
    """
    watched = [score, *[f for f in features if f != score]]
    p = kolmogorov_p(F.col("ks"), F.col("ref_total"), F.col("cur_total"))
    seen = compared(profile.where(F.col("feature").isin(watched)), batch).withColumns(
        {"psi": F.expr(PSI_SHARES_SQL), "p_value": p}
    )
    # one row per watched feature
    names = batch.sparkSession.createDataFrame([(f,) for f in watched], "feature string")
    out = names.join(seen, "feature", "left").withColumn("n_samples", F.coalesce("cur_total", F.lit(0)).cast("long"))
    is_score = F.col("feature") == score
    lost = F.col("n_samples") == 0
    alert = F.when(lost | (F.col("psi") > PSI_ALERT), "ALERT").when(is_score & (F.col("psi") > PSI_WARN), "WARN")

    def shown(name: str) -> Column:
        return F.when(~lost, F.round(name, 5)).alias(name)

    return out.select(
        F.lit(batch_label).alias("batch_label"),
        "feature",
        is_score.alias("is_score"),
        shown("psi"),
        shown("ks"),
        shown("ks_upper"),
        shown("p_value"),
        F.when(lost, F.lit("no values")).otherwise(psi_label(F.col("psi"))).alias("status"),
        alert.alias("alert"),
        "n_samples",
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    n_bins: int = 10,
    psi_limit: float = PSI_FLAG,
    ks_limit: float = KS_FLAG,
    k: int = SKETCH_K,
) -> DataFrame:
    """The drift report on sketches: two scans of the reference, one of the current table, no
    shuffle of values. Columns as in :func:`drift.drift_report`, and ``ks_upper``.
    """
    features = common_numeric(reference, current)
    if not features:
        return reference.sparkSession.createDataFrame([], EMPTY_REPORT + ", ks_upper double")
    profile = freeze(reference, features, n_bins, exact=False, uniform=True, null_as=NULL_BIN, k=k)
    out = compared(profile, current, NULL_BIN).withColumn("psi", F.expr(PSI_COUNTS_SQL))
    out = out.select("feature", "psi", "ks", "ks_upper", "ref_null_rate", "cur_null_rate", "n_outside")
    out = out.withColumn("null_shift", F.abs(F.col("cur_null_rate") - F.col("ref_null_rate")))
    drifted = (F.col("psi") > psi_limit) | (F.col("ks") > ks_limit)
    return rounded(out.withColumn("drifted", drifted)).orderBy(F.col("psi").desc(), "feature")
