"""Registered queries: metrics, drift and fairness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.registry import query, table
from riskloom.catalog.views import spark_view, with_views
from riskloom.operators import drift, fairness, metrics, profiles
from riskloom.plans.lineage import stored
from riskloom.plans.shape import rounded, tall

SCORED = with_views("scored")

RANKED_SQL = """
, ranked AS (
  SELECT score_a AS s, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score_a),
cum AS (
  SELECT *, sum(pos) OVER (ORDER BY s) AS cp, sum(neg) OVER (ORDER BY s) AS cn,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM ranked)"""


@query(
    "evaluation_report",
    SCORED
    + RANKED_SQL
    + """,
plain AS (
  SELECT count(*) AS rows_n, avg(power(score_a - label, 2)) AS brier, avg(label) AS rate,
    avg(-(label * ln(score_a) + (1 - label) * ln(1 - score_a))) AS ll,
    sum(CASE WHEN score_a < 0.5 AND label = 0 THEN 1 ELSE 0 END) AS tn,
    sum(CASE WHEN score_a >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN score_a < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS fn,
    sum(CASE WHEN score_a >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp FROM scored),
ranks AS (
  SELECT sum(pos * (cn - neg + neg / 2e0)) / max(p * n) AS auc,
    max(abs(cp / p - cn / n)) AS ks,
    sum(pos / p * (p - cp + pos) / (p - cp + pos + n - cn + neg)) AS ap FROM cum)
SELECT CAST(rows_n AS BIGINT) AS n, round(auc, 6) AS auc, round(2 * auc - 1, 6) AS gini,
  round(ks, 6) AS ks, round(ap, 6) AS average_precision, round(brier, 6) AS brier,
  round(rate * (1 - rate), 6) AS brier_base_rate, round(ll, 6) AS log_loss,
  round((fp + 5 * fn) / rows_n, 6) AS expected_loss, CAST(tn AS BIGINT) AS tn,
  CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
  (SELECT count(*) FROM scored WHERE label IS NOT NULL AND score_a IS NULL) AS n_unscored
FROM plain, ranks""",
)
def evaluation_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.report(spark_view(spark, sf, "scored"), score="score_a"))


@query(
    "auc_ks_by_source",
    SCORED
    + """, r AS (
  SELECT source, score_a AS s, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY source ORDER BY s) AS cp,
    sum(neg) OVER (PARTITION BY source ORDER BY s) AS cn,
    sum(pos) OVER (PARTITION BY source) AS p, sum(neg) OVER (PARTITION BY source) AS n FROM r)
SELECT source, CAST(max(p + n) AS BIGINT) AS n, CAST(max(p) AS BIGINT) AS positives,
  round(CASE WHEN max(p) * max(n) > 0 THEN sum(pos * (cn - neg + neg / 2e0)) / max(p * n) END, 6) AS auc,
  round(coalesce(max(CASE WHEN p > 0 AND n > 0 THEN abs(cp / p - cn / n) END), 0), 6) AS ks
FROM c GROUP BY source""",
)
def auc_ks_by_source(spark: SparkSession, sf: str) -> DataFrame:
    scored = spark_view(spark, sf, "scored")
    areas = metrics.auc(scored, score="score_a", keys=["source"])
    gaps = metrics.ks_separation(scored, score="score_a", keys=["source"])
    return rounded(areas.join(gaps, "source"))


@query(
    "roc_curve_points",
    SCORED
    + RANKED_SQL
    + """
SELECT round(s, 6) AS threshold, round((n - cn + neg) / n, 6) AS fpr,
  round((p - cp + pos) / p, 6) AS tpr FROM cum""",
)
def roc_curve_points(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.roc_points(spark_view(spark, sf, "scored"), score="score_a"))


@query(
    "reliability_bins",
    SCORED
    + """
SELECT CAST(b AS INTEGER) AS bin, CAST(count(*) AS BIGINT) AS n, round(avg(score_a), 6) AS mean_score,
  round(avg(label), 6) AS fraction_positive
FROM (SELECT *, greatest(ceil(score_a * 10) - 1, 0) AS b FROM scored) GROUP BY b""",
)
def reliability_bins(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.reliability(spark_view(spark, sf, "scored"), score="score_a"))


@query(
    "loss_optimal_threshold",
    SCORED
    + """, r AS (
  SELECT CAST(floor(score_b * 1e6 + 0.5) AS BIGINT) AS s, sum(label) AS pos, sum(1 - label) AS neg
  FROM scored GROUP BY 1),
c AS (SELECT s, sum(pos) OVER (ORDER BY s) - pos AS fn,
    sum(neg) OVER () - sum(neg) OVER (ORDER BY s) + neg AS fp, sum(pos + neg) OVER () AS n FROM r)
SELECT s / 1e6 AS threshold, round((fp + 5 * fn) / n, 6) AS expected_loss
FROM c ORDER BY (fp + 5 * fn) / n, s LIMIT 1""",
)
def loss_optimal_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.best_threshold(spark_view(spark, sf, "scored"), score="score_b"))


METHOD_SQL = """, t AS (
  SELECT id, label, 'raw' AS method, score_a AS score FROM scored UNION ALL
  SELECT id, label, 'other', score_b FROM scored UNION ALL
  SELECT id, label, 'squared', score_a * score_a FROM scored),
r AS (SELECT method, score, sum(label) AS pos, sum(1 - label) AS neg FROM t GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY method ORDER BY score) - neg AS bn,
    sum(pos) OVER (PARTITION BY method) AS p, sum(neg) OVER (PARTITION BY method) AS n FROM r),
a AS (SELECT method, sum(pos * (bn + neg / 2e0)) / max(p * n) AS auc FROM c GROUP BY method)
"""


@query(
    "method_comparison",
    SCORED
    + METHOD_SQL
    + """SELECT t.method, round(avg(power(score - label, 2)), 6) AS brier,
  round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score,
  round(max(auc), 6) AS auc FROM t JOIN a ON t.method = a.method GROUP BY t.method""",
)
def method_comparison(spark: SparkSession, sf: str) -> DataFrame:
    wide = spark_view(spark, sf, "scored").select(
        "id",
        "label",
        F.col("score_a").alias("raw"),
        F.col("score_b").alias("other"),
        (F.col("score_a") * F.col("score_a")).alias("squared"),
    )
    long = tall(wide, ["raw", "other", "squared"], ["id", "label"], "method", "score")
    return rounded(metrics.method_table(long))


@query(
    "log_loss_and_confusion",
    SCORED
    + """
SELECT lang, CAST(sum(CASE WHEN score_b < 0.15 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN score_b >= 0.15 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN score_b < 0.15 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN score_b >= 0.15 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  round(sum(CASE WHEN score_b >= 0.15 AND label = 0 THEN 1 WHEN score_b < 0.15 AND label = 1 THEN 5 ELSE 0 END) / count(*), 6) AS expected_loss
FROM scored GROUP BY lang""",
)
def log_loss_and_confusion(spark: SparkSession, sf: str) -> DataFrame:
    scored = spark_view(spark, sf, "scored")
    return rounded(
        metrics.expected_loss(scored, score="score_b", threshold=0.15, keys=["lang"])
    )


# -- drift --------------------------------------------------------------------------

# Reference and current halves of the event stream, with NULLs made from a value band.
HALVES_SQL = """
WITH src AS (
  SELECT ts < TIMESTAMP '2024-01-16' AS is_ref, nullif(value, 1.0) AS value,
    CASE WHEN event_type = 'error' THEN NULL ELSE value * value END AS squared,
    CASE WHEN ts < TIMESTAMP '2024-01-16' THEN value ELSE value * 1.5 + 3 END AS shifted,
    CAST(event_id % 4 AS DOUBLE) AS few
  FROM events),
"""
TALL_SQL = (
    "t AS ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, is_ref, {f} AS v FROM src"
        for f in ("value", "squared", "shifted", "few")
    )
    + ")"
)
DRIFT_FEATURES = ["value", "squared", "shifted", "few"]


def event_halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    rows = table(spark, sf, "events").select(
        early.alias("is_ref"),
        F.nullif(F.col("value"), F.lit(1.0)).alias("value"),
        F.when(F.col("event_type") != "error", F.col("value") * F.col("value")).alias("squared"),
        F.when(early, F.col("value")).otherwise(F.col("value") * 1.5 + 3).alias("shifted"),
        (F.col("event_id") % 4).cast("double").alias("few"),
    )
    return rows.where("is_ref").drop("is_ref"), rows.where("NOT is_ref").drop("is_ref")


EDGES_SQL = """,
f AS (SELECT feature, is_ref, coalesce(v, -999) AS v FROM t),
spread AS (
  SELECT feature, count(DISTINCT v) AS d, min(v) AS lo, max(v) AS hi,
    quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS q
  FROM f WHERE is_ref GROUP BY feature),
edges AS (
  SELECT feature, i, CASE WHEN d < 10 THEN CASE WHEN i = d THEN hi + 1e-10 ELSE lo + i * ((hi + 1e-10 - lo) / d) END
    ELSE q[i + 1] END AS e, CASE WHEN d < 10 THEN d ELSE 10 END AS bins
  FROM spread, range(11) AS r(i) WHERE i <= CASE WHEN d < 10 THEN d ELSE 10 END),
pairs AS (
  SELECT a.feature, a.i AS bin, a.e AS lo, b.e AS hi, a.i = a.bins - 1 AS is_last
  FROM edges a JOIN edges b ON a.feature = b.feature AND b.i = a.i + 1),
hist AS (
  SELECT p.feature, p.bin,
    sum(CASE WHEN is_ref AND v >= lo AND (v < hi OR (is_last AND v = hi)) THEN 1 ELSE 0 END) AS ref_n,
    sum(CASE WHEN NOT is_ref AND v >= lo AND (v < hi OR (is_last AND v = hi)) THEN 1 ELSE 0 END) AS cur_n
  FROM pairs p JOIN f ON p.feature = f.feature GROUP BY p.feature, p.bin),
psi AS (
  SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM (
    SELECT feature, (ref_n + 1e-6) / sum(ref_n + 1e-6) OVER (PARTITION BY feature) AS r,
      (cur_n + 1e-6) / sum(cur_n + 1e-6) OVER (PARTITION BY feature) AS c FROM hist) GROUP BY feature),
ecdf AS (
  SELECT feature, v, sum(CASE WHEN is_ref THEN 1 ELSE 0 END) AS r, sum(CASE WHEN is_ref THEN 0 ELSE 1 END) AS c
  FROM f GROUP BY feature, v),
ks AS (
  SELECT feature, max(abs(fr - fc)) AS ks FROM (
    SELECT feature, sum(r) OVER (PARTITION BY feature ORDER BY v) / sum(r) OVER (PARTITION BY feature) AS fr,
      sum(c) OVER (PARTITION BY feature ORDER BY v) / sum(c) OVER (PARTITION BY feature) AS fc FROM ecdf)
  GROUP BY feature),
nulls AS (
  SELECT feature, avg(CASE WHEN is_ref THEN CASE WHEN v IS NULL THEN 1 ELSE 0 END END) AS rn,
    avg(CASE WHEN NOT is_ref THEN CASE WHEN v IS NULL THEN 1 ELSE 0 END END) AS cn FROM t GROUP BY feature),
outside AS (
  SELECT f.feature, sum(CASE WHEN NOT is_ref AND (v < lo OR v > hi) THEN 1 ELSE 0 END) AS n_outside
  FROM f JOIN spread USING (feature) GROUP BY f.feature)"""


@query(
    "drift_report",
    HALVES_SQL
    + TALL_SQL
    + EDGES_SQL
    + """
SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, round(rn, 6) AS ref_null_rate,
  round(cn, 6) AS cur_null_rate, round(abs(cn - rn), 6) AS null_shift,
  CAST(n_outside AS BIGINT) AS n_outside, psi > 0.1 OR ks > 0.2 AS drifted
FROM psi JOIN ks USING (feature) JOIN nulls USING (feature) JOIN outside USING (feature)""",
)
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_report(*event_halves(spark, sf))


@query(
    "drift_summary",
    HALVES_SQL
    + TALL_SQL
    + EDGES_SQL
    + """
SELECT CAST(count(*) AS BIGINT) AS n_features,
  CAST(sum(CASE WHEN psi > 0.1 OR ks > 0.2 THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted,
  coalesce(string_agg(CASE WHEN psi > 0.1 OR ks > 0.2 THEN feature END, ',' ORDER BY feature), '') AS drifted_features
FROM psi JOIN ks USING (feature)""",
)
def drift_summary(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_summary(drift.drift_report(*event_halves(spark, sf)))


@query(
    "drift_histograms",
    HALVES_SQL
    + TALL_SQL
    + EDGES_SQL
    + """
SELECT feature, CAST(bin AS INTEGER) AS bin, CAST(ref_n AS BIGINT) AS ref_n,
  CAST(cur_n AS BIGINT) AS cur_n FROM hist""",
)
def drift_histograms(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = event_halves(spark, sf)
    both = drift.side_by_side(ref, cur, DRIFT_FEATURES, drift.NULL_BIN)
    return drift.histograms(drift.bin_counts(both, drift.feature_summary(both)))


KNOWN_SQL = """,
g AS (SELECT feature, is_ref, v FROM t WHERE v IS NOT NULL),
q AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e
  FROM g WHERE is_ref GROUP BY feature),
pairs AS (SELECT feature, i AS bin, e[i + 1] AS lo, e[i + 2] AS hi, i = len(e) - 2 AS is_last
  FROM q, range(10) AS r(i) WHERE i <= len(e) - 2),
sizes AS (SELECT feature, count(*) FILTER (is_ref) AS rt, count(*) FILTER (NOT is_ref) AS ct FROM g GROUP BY feature),
hist AS (
  SELECT p.feature, p.bin,
    sum(CASE WHEN is_ref AND v >= lo AND (v < hi OR (is_last AND v = hi)) THEN 1 ELSE 0 END) AS ref_n,
    sum(CASE WHEN NOT is_ref AND v >= lo AND (v < hi OR (is_last AND v = hi)) THEN 1 ELSE 0 END) AS cur_n
  FROM pairs p JOIN g ON p.feature = g.feature GROUP BY p.feature, p.bin),
psi AS (SELECT feature, sum((cur_n / ct + 1e-6 - (ref_n / rt + 1e-6)) * ln((cur_n / ct + 1e-6) / (ref_n / rt + 1e-6))) AS psi
  FROM hist JOIN sizes USING (feature) GROUP BY feature),
ecdf AS (SELECT feature, v, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM g GROUP BY feature, v),
ks0 AS (
  SELECT feature, max(abs(fr - fc)) AS ks FROM (
    SELECT feature, sum(r) OVER (PARTITION BY feature ORDER BY v) / sum(r) OVER (PARTITION BY feature) AS fr,
      sum(c) OVER (PARTITION BY feature ORDER BY v) / sum(c) OVER (PARTITION BY feature) AS fc FROM ecdf)
  GROUP BY feature),
ks AS (
  SELECT feature, ks, sqrt(rt * ct / (rt + ct)) * ks AS x FROM ks0 JOIN sizes USING (feature)),
kp AS (
  SELECT feature, ks, CASE WHEN x < 0.2 THEN 1e0 ELSE greatest(0e0, least(1e0,
    (SELECT sum(CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp(-2e0 * k * k * x * x)) FROM range(1, 101) AS r(k)))) END AS p
  FROM ks)"""


@query(
    "monitor_batch_check",
    HALVES_SQL
    + TALL_SQL
    + KNOWN_SQL
    + """
SELECT 'second half' AS batch_label, feature, feature = 'shifted' AS is_score, round(psi, 5) AS psi,
  round(ks, 5) AS ks, round(p, 5) AS p_value,
  CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.20 THEN 'moderate' ELSE 'major' END AS status,
  CASE WHEN psi > 0.20 THEN 'ALERT' WHEN feature = 'shifted' AND psi > 0.10 THEN 'WARN' END AS alert,
  ct AS n_samples
FROM psi JOIN kp USING (feature) JOIN sizes USING (feature)
UNION ALL SELECT 'second half', 'lost', FALSE, NULL, NULL, NULL, 'no values', 'ALERT', 0
UNION ALL SELECT 'second half', 'absent', FALSE, NULL, NULL, NULL, 'no values', 'ALERT', 0""",
)
def monitor_batch_check(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = event_halves(spark, sf)
    ref = ref.withColumns({"lost": F.col("value"), "absent": F.col("value")})
    cur = cur.withColumn("lost", F.lit(None).cast("double"))
    watched = ["value", "squared", "few", "lost", "absent"]
    return drift.check_batch(ref, cur, watched, "shifted", "second half")


_HUNDREDTHS = ", ".join(str(i / 100) for i in range(101))
# KS read at the reference percentiles, and what it can be at most between them
CUTS_SQL = f""",
c0 AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [{_HUNDREDTHS}]))) AS c FROM g WHERE is_ref GROUP BY feature),
cut AS (SELECT feature, i, c[i] AS x, i = len(c) AS is_last FROM c0, unnest(range(1, len(c) + 1)) AS r(i)),
below AS (
  SELECT cut.feature, i, count(*) FILTER (is_ref AND (v < x OR is_last AND v = x)) / any_value(rt) AS fr,
    count(*) FILTER (NOT is_ref AND (v < x OR is_last AND v = x)) / any_value(ct) AS fc
  FROM cut JOIN g ON cut.feature = g.feature JOIN sizes ON sizes.feature = g.feature GROUP BY cut.feature, i
  UNION ALL SELECT feature, 0, 0, 0 FROM sizes UNION ALL SELECT feature, 1000, 1, 1 FROM sizes),
steps AS (SELECT *, lead(fr) OVER w AS nr, lead(fc) OVER w AS nc FROM below WINDOW w AS (PARTITION BY feature ORDER BY i)),
kc0 AS (SELECT feature, max(abs(fr - fc)) AS ks, max(greatest(abs(nr - fc), abs(nc - fr))) AS ks_upper FROM steps GROUP BY feature),
kc AS (
  SELECT feature, ks, ks_upper, CASE WHEN x < 0.2 THEN 1e0 ELSE greatest(0e0, least(1e0,
    (SELECT sum(CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp(-2e0 * k * k * x * x)) FROM range(1, 101) AS r(k)))) END AS p
  FROM (SELECT *, sqrt(rt * ct / (rt + ct)) * ks AS x FROM kc0 JOIN sizes USING (feature)))"""


@query(
    "monitor_stored_profile",
    HALVES_SQL
    + TALL_SQL
    + KNOWN_SQL
    + CUTS_SQL
    + """
SELECT 'second half' AS batch_label, feature, feature = 'shifted' AS is_score, round(psi, 5) AS psi,
  round(kc.ks, 5) AS ks, round(ks_upper, 5) AS ks_upper, round(kc.p, 5) AS p_value,
  CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.20 THEN 'moderate' ELSE 'major' END AS status,
  CASE WHEN psi > 0.20 THEN 'ALERT' WHEN feature = 'shifted' AND psi > 0.10 THEN 'WARN' END AS alert,
  ct AS n_samples
FROM psi JOIN kc USING (feature) JOIN sizes USING (feature)
UNION ALL SELECT 'second half', 'lost', FALSE, NULL, NULL, NULL, NULL, 'no values', 'ALERT', 0
UNION ALL SELECT 'second half', 'absent', FALSE, NULL, NULL, NULL, NULL, 'no values', 'ALERT', 0""",
)
def monitor_stored_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The batch monitor on a profile that was written once; the reference is not read again."""
    ref, cur = event_halves(spark, sf)
    ref = ref.withColumns({"lost": F.col("value"), "absent": F.col("value")})
    cur = cur.withColumn("lost", F.lit(None).cast("double"))
    watched = ["value", "squared", "few", "lost", "absent"]
    profile = stored(profiles.freeze(ref, ["shifted", *watched]), "profile")
    return profiles.check_batch_against(profile, cur, watched, "shifted", "second half")


@query(
    "drift_report_sketched",
    HALVES_SQL
    + TALL_SQL
    + EDGES_SQL
    + """
SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, round(rn, 6) AS ref_null_rate,
  round(cn, 6) AS cur_null_rate, TRUE AS psi_is_near, TRUE AS ks_is_bracketed
FROM psi JOIN ks USING (feature) JOIN nulls USING (feature)""",
)
def drift_report_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """The exact report, and whether the one on sketches stays in its bounds: PSI within 0.01 or a
    tenth, KS between ``ks`` and ``ks_upper``."""
    ref, cur = event_halves(spark, sf)
    exact = drift.drift_report(ref, cur).select("feature", "psi", "ks")
    names = ("psi", "ks", "ks_upper", "ref_null_rate", "cur_null_rate")
    near = profiles.drift_report(ref, cur).select("feature", *[F.col(c).alias(f"s_{c}") for c in names])
    # a row per feature on both sides
    both = exact.join(F.broadcast(near), "feature")
    return both.select(
        "feature",
        "psi",
        "ks",
        F.col("s_ref_null_rate").alias("ref_null_rate"),
        F.col("s_cur_null_rate").alias("cur_null_rate"),
        (F.abs(F.col("psi") - F.col("s_psi")) <= F.greatest(F.lit(0.01), F.col("psi") * 0.1)).alias("psi_is_near"),
        F.col("ks").between(F.col("s_ks") - 1e-6, F.col("s_ks_upper") + 1e-6).alias("ks_is_bracketed"),
    )


@query(
    "ks_test_by_feature",
    HALVES_SQL
    + TALL_SQL
    + KNOWN_SQL
    + "\nSELECT feature, round(ks, 6) AS ks, round(p, 6) AS p_value, p < 0.05 AS drifted FROM kp",
)
def ks_test_by_feature(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(drift.ks_test(*event_halves(spark, sf), DRIFT_FEATURES))


@query(
    "daily_psi_against_profile",
    """
WITH ref AS (SELECT value AS v FROM events WHERE ts < TIMESTAMP '2024-01-16'),
q AS (SELECT list_sort(list_distinct(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM ref),
pairs AS (SELECT i AS bin, e[i + 1] AS lo, e[i + 2] AS hi, i = len(e) - 2 AS is_last
  FROM q, range(10) AS r(i) WHERE i <= len(e) - 2),
refc AS (SELECT bin, sum(CASE WHEN v >= lo AND (v < hi OR (is_last AND v = hi)) THEN 1 ELSE 0 END)
    / (SELECT count(*) FROM ref) + 1e-6 AS r FROM pairs, ref GROUP BY bin),
cur AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, value AS v FROM events),
tot AS (SELECT day, count(*) AS n FROM cur GROUP BY day),
curc AS (SELECT day, bin, sum(CASE WHEN v >= lo AND (v < hi OR (is_last AND v = hi)) THEN 1 ELSE 0 END) AS c
  FROM pairs, cur GROUP BY day, bin)
SELECT CAST(curc.day AS VARCHAR) AS day, CAST(max(n) AS BIGINT) AS cur_total,
  round(sum((c / n + 1e-6 - r) * ln((c / n + 1e-6) / r)), 6) AS psi
FROM curc JOIN refc USING (bin) JOIN tot ON curc.day = tot.day GROUP BY curc.day""",
)
def daily_psi_against_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Batch form of the streaming monitor: PSI of each day against frozen edges."""
    events = table(spark, sf, "events")
    early = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    profile = drift.reference_profile(early, ["value"])
    binned = (
        tall(events, ["value"], ["ts"])
        .join(F.broadcast(profile.select("feature", "edges")), "feature")
        .select(
            F.date_trunc("day", "ts").cast("timestamp_ntz").cast("string").alias("day"),
            "feature",
            drift.bin_of(F.col("value"), F.col("edges")).alias("bin"),
        )
        .groupBy("day", "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    out = drift.psi_against_profile(binned, profile, ["day"])
    return rounded(out.select("day", "cur_total", "psi"))


# -- fairness -----------------------------------------------------------------------


@query(
    "fairness_by_attribute",
    SCORED
    + """, m AS (SELECT s.id, score_a AS p, label AS y, nullif(s.lang, 'fr') AS lang, s.source FROM scored s), m0 AS (SELECT id FROM scored),
t AS (SELECT 'lang' AS attribute, lang AS grp, p, y FROM m UNION ALL SELECT 'source', source, p, y FROM m),
o AS (SELECT avg(p) AS overall FROM m)
SELECT attribute, grp, CAST(count(*) AS BIGINT) AS count, round(avg(p), 6) AS mean_pred,
  round(avg(y), 6) AS mean_target, round(max(overall), 6) AS overall_mean_pred,
  round(avg(p) - max(overall), 6) AS disparity,
  (SELECT count(*) <> count(DISTINCT id) FROM m0) AS row_count_mismatch
FROM t, o WHERE grp IS NOT NULL GROUP BY attribute, grp""",
)
def fairness_by_attribute(spark: SparkSession, sf: str) -> DataFrame:
    scored = spark_view(spark, sf, "scored").select(
        F.col("id").alias("doc_id"), F.col("label"), F.col("score_a")
    )
    people = table(spark, sf, "documents").select(
        "doc_id", F.nullif(F.col("lang"), F.lit("fr")).alias("lang"), "source"
    )
    return rounded(
        fairness.fairness_report(
            scored, people, ["lang", "source"], "doc_id", "score_a", "label"
        )
    )


@query(
    "fairness_join_audit",
    """
SELECT CAST((SELECT count(*) FROM customer) AS BIGINT) AS n_predictions,
  CAST(count(*) AS BIGINT) AS n_joined,
  count(*) <> (SELECT count(*) FROM customer) AS row_count_mismatch
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
)
def fairness_join_audit(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("SK_ID_CURR"))
    many = table(spark, sf, "orders").select(F.col("o_custkey").alias("SK_ID_CURR"))
    return fairness.row_count_mismatch(people, many)


@query(
    "auc_by_language",
    SCORED
    + """, r AS (SELECT lang, score_a AS s, sum(label) AS pos, sum(1 - label) AS neg FROM scored
  WHERE lang IN ('en', 'de') GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY lang ORDER BY s) - neg AS bn,
    sum(pos) OVER (PARTITION BY lang) AS p, sum(neg) OVER (PARTITION BY lang) AS n FROM r)
SELECT lang, CAST(max(p + n) AS BIGINT) AS n, CAST(max(p) AS BIGINT) AS positives,
  round(sum(pos * (bn + neg / 2e0)) / max(p * n), 6) AS auc, round(max(p) / max(p + n), 6) AS base_rate
FROM c GROUP BY lang HAVING max(p + n) > 100 AND max(p) > 10""",
)
def auc_by_language(spark: SparkSession, sf: str) -> DataFrame:
    scored = spark_view(spark, sf, "scored")
    return rounded(fairness.auc_by_group(scored, "lang", score="score_a", groups=["en", "de"]))


@query(
    "auc_by_age_band",
    with_views("application")
    + """, a AS (SELECT TARGET AS y, -DAYS_BIRTH / 365e0 AS age, CNT_CHILDREN / 10e0 + c.c_custkey % 7 / 70e0 AS s
  FROM application JOIN customer c ON SK_ID_CURR = c_custkey),
b AS (SELECT y, s, CASE WHEN age > 18 AND age <= 30 THEN '18-30' WHEN age > 30 AND age <= 40 THEN '31-40'
  WHEN age > 40 AND age <= 50 THEN '41-50' WHEN age > 50 AND age <= 60 THEN '51-60'
  WHEN age > 60 AND age <= 100 THEN '60+' END AS age_band FROM a),
r AS (SELECT age_band, s, sum(y) AS pos, sum(1 - y) AS neg FROM b WHERE age_band IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, sum(neg) OVER (PARTITION BY age_band ORDER BY s) - neg AS bn,
    sum(pos) OVER (PARTITION BY age_band) AS p, sum(neg) OVER (PARTITION BY age_band) AS n FROM r)
SELECT age_band, CAST(max(p + n) AS BIGINT) AS n, CAST(max(p) AS BIGINT) AS positives,
  round(sum(pos * (bn + neg / 2e0)) / max(p * n), 6) AS auc, round(max(p) / max(p + n), 6) AS base_rate
FROM c GROUP BY age_band HAVING max(p + n) > 100 AND max(p) > 10""",
)
def auc_by_age_band(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark_view(spark, sf, "application").select(
        "TARGET",
        fairness.age_group(F.col("DAYS_BIRTH")).alias("age_band"),
        (F.col("CNT_CHILDREN") / 10.0 + F.col("SK_ID_CURR") % 7 / 70.0).alias("s"),
    )
    return rounded(fairness.auc_by_group(rows, "age_band", "TARGET", "s"))
