"""Registered queries: profiling, encoders, folds and feature selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.features import APP_WITH, clean_application
from riskloom.catalog.registry import query, table
from riskloom.catalog.views import spark_view, with_views
from riskloom.operators import encoders, folds, profiling, selection
from riskloom.plans.shape import rounded

APP = with_views("application")


@query(
    "category_distribution",
    """
SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n,
  round(count(*) / (SELECT count(*) FROM customer), 6) AS share FROM customer GROUP BY 1""",
)
def category_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profiling.distribution(table(spark, sf, "customer"), "c_mktsegment"))


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "late_quantity"]


@query(
    "describe_numeric",
    """
WITH l AS (SELECT *, CASE WHEN l_returnflag = 'A' THEN l_quantity END AS late_quantity FROM lineitem),
t AS ("""
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v FROM l" for c in DESCRIBED)
    + """)
SELECT feature, CAST(count(v) AS BIGINT) AS count, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
  round(min(v), 4) AS min, round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50,
  round(quantile_cont(v, 0.75), 4) AS p75, round(max(v), 4) AS max
FROM t GROUP BY feature""",
)
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").withColumn(
        "late_quantity", F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))
    )
    return rounded(profiling.describe(rows, DESCRIBED), 4)


MISSING_COLUMNS = [
    "SK_ID_CURR",
    "AMT_GOODS_PRICE",
    "DAYS_EMPLOYED",
    "EXT_SOURCE_1",
    "EXT_SOURCE_3",
    "OCCUPATION_TYPE",
    "CODE_GENDER",
    "CNT_CHILDREN",
]


@query(
    "missing_report",
    APP_WITH
    + ", t AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS k, count(*) AS n,"
        f" '{'string' if c in ('OCCUPATION_TYPE', 'CODE_GENDER') else 'int' if c == 'DAYS_EMPLOYED' else 'double'}' AS dtype FROM app"
        for c in MISSING_COLUMNS
    )
    + """)
SELECT feature, CAST(k AS BIGINT) AS missing_count, round(k * 100e0 / n, 2) AS missing_pct, dtype
FROM t WHERE k > 0 ORDER BY k DESC LIMIT 40""",
)
def missing_report(spark: SparkSession, sf: str) -> DataFrame:
    app = clean_application(spark, sf)
    return profiling.missing_report(app.select(MISSING_COLUMNS), top=40)


RATE_COLUMNS = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_GOODS_PRICE", "OCCUPATION_TYPE"]


@query(
    "missing_vs_target",
    APP
    + ", r AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN TARGET END) * 100 AS m,"
        f" avg(CASE WHEN {c} IS NOT NULL THEN TARGET END) * 100 AS p FROM application"
        for c in RATE_COLUMNS
    )
    + """)
SELECT feature, round(m, 2) AS rate_missing, round(p, 2) AS rate_present, round(m - p, 2) AS difference FROM r""",
)
def missing_vs_target(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.missing_vs_target(spark_view(spark, sf, "application"), RATE_COLUMNS, "TARGET")


@query(
    "sentinel_audit",
    APP
    + """
SELECT CAST(count(*) FILTER (DAYS_EMPLOYED = 365243) AS BIGINT) AS n_sentinel,
  round(avg(CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END), 6) AS share,
  round(avg(TARGET) FILTER (DAYS_EMPLOYED = 365243), 6) AS rate_sentinel,
  round(avg(TARGET) FILTER (DAYS_EMPLOYED <> 365243), 6) AS rate_other,
  CAST(min(DAYS_EMPLOYED) AS DOUBLE) AS min_value FROM application""",
)
def sentinel_audit(spark: SparkSession, sf: str) -> DataFrame:
    app = spark_view(spark, sf, "application")
    return rounded(profiling.sentinel_audit(app, "DAYS_EMPLOYED", 365243, "TARGET"))


@query(
    "target_rate_by_segment",
    APP
    + """
SELECT OCCUPATION_TYPE, round(avg(TARGET), 6) AS target_rate, CAST(count(*) AS BIGINT) AS n,
  round((SELECT avg(TARGET) FROM application), 6) AS overall_rate
FROM application WHERE OCCUPATION_TYPE IS NOT NULL GROUP BY 1 HAVING count(*) >= 100""",
)
def target_rate_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    app = spark_view(spark, sf, "application")
    return rounded(profiling.target_rate_by_category(app, "OCCUPATION_TYPE", "TARGET"))


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "high_price", "same"]
_LINE_SQL = """l AS (SELECT l_quantity, l_extendedprice, l_discount, 7e0 AS same,
  CASE WHEN l_extendedprice > 20000 THEN l_extendedprice END AS high_price,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        F.lit(7.0).alias("same"),
        F.when(price > 20000, price).alias("high_price"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
    )


@query(
    "pairwise_correlation",
    f"WITH {_LINE_SQL}"
    + " UNION ALL ".join(
        f" SELECT '{a}' AS a, '{b}' AS b, "
        f"round(corr({a}, {b}), 6) AS corr FROM l"
        for i, a in enumerate(CORRELATED)
        for b in CORRELATED[i + 1 :]
        if b != "same"
    )
    + "".join(
        f" UNION ALL SELECT '{a}', 'same', CAST(NULL AS DOUBLE)" for a in CORRELATED if a != "same"
    ),
)
def pairwise_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Pairwise complete over the NULLs of ``high_price``; a constant column gives NULL."""
    return rounded(profiling.correlations(_lines(spark, sf), CORRELATED))


@query(
    "correlation_with_target",
    f"WITH {_LINE_SQL}, r AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr({c}, y) AS corr FROM l" for c in CORRELATED if c != "same"
    )
    + ") SELECT feature, round(corr, 6) AS corr FROM r ORDER BY abs(corr) DESC LIMIT 3",
)
def correlation_with_target(spark: SparkSession, sf: str) -> DataFrame:
    columns = [c for c in CORRELATED if c != "same"]
    return rounded(profiling.correlation_with_target(_lines(spark, sf), columns, "y", top=3))


EMBED = [f"e{i}" for i in range(64)]
EMBED_SQL = (
    "e AS (SELECT vec_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64))
    + ", CASE WHEN CAST(embedding[1] AS DOUBLE) + 5e-1 * CAST(embedding[2] AS DOUBLE) > 0 THEN 1 ELSE 0 END AS label"
    + " FROM embeddings)"
)


def embedding_features(spark: SparkSession, sf: str) -> DataFrame:
    """64 numeric columns with a label planted on the first two."""
    at = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)]
    rows = table(spark, sf, "embeddings").select("vec_id", *at)
    return rows.withColumn(
        "label", F.when(F.col("e0") + 0.5 * F.col("e1") > 0, 1).otherwise(0)
    )


@query(
    "embedding_correlations",
    "WITH "
    + EMBED_SQL
    + """, t AS (UNPIVOT (SELECT * EXCLUDE (label) FROM e) ON COLUMNS(* EXCLUDE (vec_id)) INTO NAME f VALUE v)
SELECT x.f AS a, y.f AS b, round(corr(x.v, y.v), 6) AS corr
FROM t x JOIN t y ON x.vec_id = y.vec_id AND CAST(substr(x.f, 2) AS INTEGER) < CAST(substr(y.f, 2) AS INTEGER)
GROUP BY x.f, y.f""",
)
def embedding_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """2016 pairs: the wide path with partial moment matrices per task."""
    return rounded(profiling.correlations(embedding_features(spark, sf), EMBED))


@query(
    "capped_price_by_flag",
    """
WITH c AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.99) AS cap FROM lineitem GROUP BY 1)
SELECT l.l_returnflag, CAST(count(*) AS BIGINT) AS n, round(max(least(l_extendedprice, cap)), 4) AS top_price,
  round(avg(least(l_extendedprice, cap)), 4) AS mean_price
FROM lineitem l JOIN c ON l.l_returnflag = c.l_returnflag GROUP BY 1""",
)
def capped_price_by_flag(spark: SparkSession, sf: str) -> DataFrame:
    capped = profiling.cap_at_percentile(
        table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice"),
        "l_extendedprice",
        "l_returnflag",
    )
    out = capped.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("l_extendedprice").alias("top_price"),
        F.avg("l_extendedprice").alias("mean_price"),
    )
    return rounded(out, 4)


@query(
    "histogram_by_class",
    """
WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events),
h AS (SELECT event_type, CAST(least(floor((value - lo) / w), 19) AS INTEGER) AS bin, lo, w FROM events, s)
SELECT event_type, bin, round(max(lo) + bin * max(w), 6) AS bin_low, CAST(count(*) AS BIGINT) AS n,
  round(count(*) / (sum(count(*)) OVER (PARTITION BY event_type) * max(w)), 6) AS density
FROM h GROUP BY event_type, bin""",
)
def histogram_by_class(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profiling.histogram(table(spark, sf, "events"), "value", 20, ["event_type"]))


@query(
    "histogram_overall",
    """
WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50 AS w FROM events),
h AS (SELECT CAST(least(floor((value - lo) / w), 49) AS INTEGER) AS bin, lo, w FROM events, s)
SELECT bin, round(max(lo) + bin * max(w), 6) AS bin_low, CAST(count(*) AS BIGINT) AS n,
  round(count(*) / (sum(count(*)) OVER () * max(w)), 6) AS density
FROM h GROUP BY bin""",
)
def histogram_overall(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profiling.histogram(table(spark, sf, "events"), "value", 50))


# -- encoders -------------------------------------------------------------------------

# Fit on urgent and high-priority orders, apply to all: the rest shows unseen clerks.
_FIT = "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"
_ORDERS_SQL = f"""
WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '2-HIGH') AS prio, o_orderstatus AS status,
    CAST(o_custkey % 11 AS VARCHAR) AS clerk, {_FIT} AS fit_row,
    CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS y FROM orders)"""


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("2-HIGH")).alias("prio"),
        F.col("o_orderstatus").alias("status"),
        (F.col("o_custkey") % 11).cast("string").alias("clerk"),
        F.expr(_FIT).alias("fit_row"),
        F.when(F.col("o_totalprice") > 150000, 1).otherwise(0).alias("y"),
    )


def _code_sql(column: str) -> str:
    return f"""{column}_map AS (SELECT {column}, CAST(row_number() OVER (ORDER BY {column}) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT {column} FROM o WHERE fit_row AND {column} IS NOT NULL))"""


@query(
    "ordinal_encoding",
    _ORDERS_SQL
    + ", "
    + ", ".join(_code_sql(c) for c in ("prio", "status", "clerk"))
    + """
SELECT o_orderkey, CASE WHEN o.prio IS NULL THEN -2 ELSE coalesce(a.code, -1) END AS prio,
  coalesce(b.code, -1) AS status, coalesce(c.code, -1) AS clerk
FROM o LEFT JOIN prio_map a ON o.prio = a.prio LEFT JOIN status_map b ON o.status = b.status
LEFT JOIN clerk_map c ON o.clerk = c.clerk""",
)
def ordinal_encoding(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders(spark, sf)
    model = encoders.OrdinalEncoder(["prio", "status", "clerk"]).fit(rows.where("fit_row"))
    return model.transform(rows).select("o_orderkey", "prio", "status", "clerk")


def _target_sql(column: str, formula: str) -> str:
    return f"""{column}_map AS (SELECT {column}, {formula} AS enc FROM (
    SELECT {column}, count(y) AS n, sum(y) AS s FROM o WHERE fit_row AND {column} IS NOT NULL GROUP BY 1), g)"""


_PRIOR_SQL = ", g AS (SELECT avg(y) AS g FROM o WHERE fit_row), "


@query(
    "target_mean_bayes",
    _ORDERS_SQL
    + _PRIOR_SQL
    + ", ".join(_target_sql(c, "(s + g * 10) / (n + 10)") for c in ("prio", "clerk"))
    + """
SELECT o_orderkey, round(coalesce(a.enc, g), 6) AS prio, round(coalesce(c.enc, g), 6) AS clerk
FROM o CROSS JOIN g LEFT JOIN prio_map a ON o.prio = a.prio LEFT JOIN clerk_map c ON o.clerk = c.clerk""",
)
def target_mean_bayes(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders(spark, sf)
    model = encoders.TargetEncoder(["prio", "clerk"]).fit(rows.where("fit_row"), "y")
    return rounded(model.transform(rows).select("o_orderkey", "prio", "clerk"))


@query(
    "target_mean_sigmoid",
    _ORDERS_SQL
    + _PRIOR_SQL
    + ", ".join(
        _target_sql(c, "1 / (1 + exp(-(n - 1) / 10e0)) * s / n + (1 - 1 / (1 + exp(-(n - 1) / 10e0))) * g")
        for c in ("prio", "clerk")
    )
    + """
SELECT o_orderkey, round(coalesce(a.enc, g), 6) AS prio, round(coalesce(c.enc, g), 6) AS clerk
FROM o CROSS JOIN g LEFT JOIN prio_map a ON o.prio = a.prio LEFT JOIN clerk_map c ON o.clerk = c.clerk""",
)
def target_mean_sigmoid(spark: SparkSession, sf: str) -> DataFrame:
    rows = _orders(spark, sf)
    encoder = encoders.TargetEncoder(["prio", "clerk"], method="sigmoid")
    model = encoder.fit(rows.where("fit_row"), "y")
    return rounded(model.transform(rows).select("o_orderkey", "prio", "clerk"))


def _fold_sql(column: str) -> str:
    return f"""{column}_map AS (
  SELECT a.{column}, a.fold, CASE WHEN tn - n > 0 THEN w * (ts - s) / (tn - n) + (1 - w) * g ELSE g END AS enc
  FROM (SELECT *, 1 / (1 + exp(-(tn - n - 1) / 10e0)) AS w FROM (
    SELECT {column}, fold, count(y) AS n, sum(y) AS s, sum(count(y)) OVER (PARTITION BY {column}) AS tn,
      sum(sum(y)) OVER (PARTITION BY {column}) AS ts
    FROM f WHERE {column} IS NOT NULL GROUP BY 1, 2)) a JOIN g ON a.fold = g.fold)"""


@query(
    "fold_safe_target_mean",
    _ORDERS_SQL
    + """, f AS (SELECT *, CAST(o_orderkey % 5 AS INTEGER) AS fold FROM o),
g AS (SELECT fold, (sum(sum(y)) OVER () - sum(y)) / (sum(count(y)) OVER () - count(y)) AS g FROM f GROUP BY fold), """
    + ", ".join(_fold_sql(c) for c in ("prio", "clerk"))
    + """
SELECT o_orderkey, f.fold, round(coalesce(a.enc, g.g), 6) AS prio_te, round(coalesce(c.enc, g.g), 6) AS clerk_te
FROM f JOIN g ON f.fold = g.fold LEFT JOIN prio_map a ON f.prio = a.prio AND f.fold = a.fold
LEFT JOIN clerk_map c ON f.clerk = c.clerk AND f.fold = c.fold""",
)
def fold_safe_target_mean(spark: SparkSession, sf: str) -> DataFrame:
    rows = folds.key_ordered_folds(_orders(spark, sf), "o_orderkey", 5)
    encoder = encoders.TargetEncoder(["prio", "clerk"], method="sigmoid")
    out = encoder.fold_safe(rows, "y").select("o_orderkey", "fold", "prio_te", "clerk_te")
    return rounded(out)


@query(
    "category_cardinality",
    _ORDERS_SQL
    + " UNION ALL ".join(
        f" SELECT '{c}' AS feature, CAST(count(DISTINCT {c}) AS BIGINT) AS n_categories,"
        f" count(DISTINCT {c}) > 5 AS high_cardinality FROM o"
        for c in ("prio", "status", "clerk")
    ),
)
def category_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return encoders.category_counts(_orders(spark, sf), ["prio", "status", "clerk"])


# -- folds ------------------------------------------------------------------------------


@query(
    "stratified_fold_sizes",
    """
WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1)
SELECT label, CAST(k AS INTEGER) AS fold, CAST(n // 5 + CASE WHEN k < n % 5 THEN 1 ELSE 0 END AS BIGINT) AS n
FROM c, range(5) AS r(k)""",
)
def stratified_fold_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per (label, fold): exact strata make the sizes a matter of arithmetic."""
    rows = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    out = folds.stratified_folds(rows, "doc_id", "label", 5)
    return out.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stratified_split_sizes",
    """
WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1)
SELECT label, TRUE AS is_eval, CAST(n // 2 AS BIGINT) AS n FROM c
UNION ALL SELECT label, FALSE, CAST(n - n // 2 AS BIGINT) FROM c""",
)
def stratified_split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    out = folds.stratified_split(rows, "doc_id", "label")
    return out.groupBy("label", "is_eval").agg(F.count(F.lit(1)).alias("n"))


# -- selection --------------------------------------------------------------------------


@query(
    "constant_columns",
    f"WITH {_LINE_SQL}, m AS (SELECT *, CAST(NULL AS DOUBLE) AS empty FROM l)"
    + " UNION ALL ".join(
        f" SELECT '{c}' AS feature, CAST(count({c}) AS BIGINT) AS n_known, count(DISTINCT {c}) <= 1 AS is_constant FROM m"
        for c in ("l_quantity", "same", "high_price", "empty")
    ),
)
def constant_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = _lines(spark, sf).withColumn("empty", F.lit(None).cast("double"))
    return selection.column_variation(rows, ["l_quantity", "same", "high_price", "empty"])


@query(
    "duplicate_columns",
    """
WITH c AS (SELECT p_retailprice AS price, CASE WHEN p_size <> 7 THEN p_retailprice ELSE p_retailprice + 1 END AS almost,
    coalesce(nullif(p_size, 3), -999) AS flagged, p_retailprice + 0 AS price_copy,
    coalesce(nullif(CAST(p_size AS DOUBLE), 3), -999) AS flagged_copy FROM part),
p AS (SELECT 'price' AS kept, 'almost' AS dropped, bool_and(price = almost) AS same FROM c UNION ALL
  SELECT 'price', 'flagged', bool_and(price = flagged) FROM c UNION ALL
  SELECT 'price', 'price_copy', bool_and(price = price_copy) FROM c UNION ALL
  SELECT 'almost', 'price_copy', bool_and(almost = price_copy) FROM c UNION ALL
  SELECT 'price', 'flagged_copy', bool_and(price = flagged_copy) FROM c UNION ALL
  SELECT 'flagged', 'flagged_copy', bool_and(flagged = flagged_copy) FROM c)
SELECT kept, dropped FROM p WHERE same""",
)
def duplicate_columns(spark: SparkSession, sf: str) -> DataFrame:
    """``almost`` differs from ``price`` in the rows of one size only."""
    price, size = F.col("p_retailprice"), F.col("p_size")
    rows = table(spark, sf, "part").select(
        "p_partkey",
        price.alias("price"),
        F.when(size != 7, price).otherwise(price + 1).alias("almost"),
        F.nullif(size, F.lit(3)).alias("flagged"),
        (price + 0.0).alias("price_copy"),
        F.nullif(size.cast("double"), F.lit(3.0)).alias("flagged_copy"),
    )
    columns = ["price", "almost", "flagged", "price_copy", "flagged_copy"]
    return selection.duplicate_columns(rows, columns, "p_partkey")


@query(
    "features_above_variance",
    "WITH "
    + EMBED_SQL
    + """, t AS (UNPIVOT (SELECT * EXCLUDE (label) FROM e) ON COLUMNS(* EXCLUDE (vec_id)) INTO NAME feature VALUE v),
s AS (SELECT feature, var_samp(v) AS variance FROM t GROUP BY feature)
SELECT feature, round(variance, 6) AS variance FROM s WHERE variance > (SELECT quantile_cont(variance, 0.5) FROM s)""",
)
def features_above_variance(spark: SparkSession, sf: str) -> DataFrame:
    rows = embedding_features(spark, sf)
    return rounded(selection.above_variance(rows, EMBED, percentile=50.0))


@query(
    "top_mutual_information",
    "WITH "
    + EMBED_SQL
    + """, t AS (UNPIVOT e ON COLUMNS(* EXCLUDE (vec_id, label)) INTO NAME feature VALUE v),
q AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM t GROUP BY feature),
b AS (SELECT t.feature, label, len(list_filter(e, lambda x: x < v)) AS bin FROM t JOIN q ON t.feature = q.feature),
j AS (SELECT feature, bin, label, count(*) AS n FROM b GROUP BY 1, 2, 3),
p AS (SELECT feature, n / sum(n) OVER (PARTITION BY feature) AS pxy,
    sum(n) OVER (PARTITION BY feature, bin) / sum(n) OVER (PARTITION BY feature) AS px,
    sum(n) OVER (PARTITION BY feature, label) / sum(n) OVER (PARTITION BY feature) AS py FROM j)
SELECT feature, round(sum(pxy * ln(pxy / (px * py))), 6) AS mutual_info FROM p GROUP BY feature
ORDER BY sum(pxy * ln(pxy / (px * py))) DESC, feature DESC LIMIT 16""",
)
def top_mutual_information(spark: SparkSession, sf: str) -> DataFrame:
    rows = embedding_features(spark, sf)
    return rounded(selection.top_by_mutual_information(rows, EMBED, "label", k=0.25))




@query(
    "redundant_features",
    f"""
WITH l AS (SELECT l_quantity AS a, l_quantity * 2 + 1 AS b, l_quantity + l_discount AS c, l_tax AS d FROM lineitem),
fi AS (SELECT * FROM (VALUES ('a', 0.5), ('b', 0.5), ('c', 0.2), ('d', 0.1)) v(feature, importance)),
pairs AS ({" UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, corr({x}, {y}) AS r FROM l" for x, y in ("ab", "ac", "ad", "bc", "bd", "cd"))})
SELECT DISTINCT CASE WHEN y.importance < x.importance THEN pairs.b ELSE pairs.a END AS feature
FROM pairs JOIN fi x ON pairs.a = x.feature JOIN fi y ON pairs.b = y.feature WHERE abs(r) > 0.95""",
)
def redundant_features(spark: SparkSession, sf: str) -> DataFrame:
    quantity = F.col("l_quantity")
    rows = table(spark, sf, "lineitem").select(
        quantity.alias("a"),
        (quantity * 2 + 1).alias("b"),
        (quantity + F.col("l_discount")).alias("c"),
        F.col("l_tax").alias("d"),
    )
    importance = spark.createDataFrame(
        [("a", 0.5), ("b", 0.5), ("c", 0.2), ("d", 0.1)], "feature string, importance double"
    )
    return selection.redundant_features(rows, list("abcd"), importance)


@query(
    "weak_features",
    """
WITH fi AS (SELECT p_brand AS feature, avg(p_size) AS importance FROM part GROUP BY 1)
SELECT feature, round(importance, 6) AS importance FROM fi
WHERE importance <= (SELECT quantile_cont(importance, 0.1) FROM fi)""",
)
def weak_features(spark: SparkSession, sf: str) -> DataFrame:
    """Bottom tenth of an importance table, the cut of iterative elimination."""
    importance = (
        table(spark, sf, "part")
        .groupBy(F.col("p_brand").alias("feature"))
        .agg(F.avg("p_size").alias("importance"))
    )
    return rounded(selection.importance_cutoff(importance))


@query(
    "zero_importance_features",
    """
WITH fi AS (SELECT p_type AS feature, sum(CASE WHEN p_size > 48 AND p_type LIKE 'S%' THEN p_size ELSE 0 END) AS importance FROM part GROUP BY 1)
SELECT feature FROM fi WHERE importance = 0""",
)
def zero_importance_features(spark: SparkSession, sf: str) -> DataFrame:
    kept = (F.col("p_size") > 48) & F.col("p_type").startswith("S")
    importance = (
        table(spark, sf, "part")
        .groupBy(F.col("p_type").alias("feature"))
        .agg(F.sum(F.when(kept, F.col("p_size")).otherwise(0)).alias("importance"))
    )
    return selection.zero_importance(importance)
