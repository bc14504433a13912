"""Registered queries: sources, row features, child profiles, assembled matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog.registry import query, table
from riskloom.catalog.views import spark_view, sql_view, with_views
from riskloom.functions import columns as fx
from riskloom.functions.naming import feature_group, feature_label
from riskloom.operators import application, assemble, children
from riskloom.operators.fairness import age_group
from riskloom.plans.joins import checked_left_join, count_without_children
from riskloom.plans.lineage import scratch_path
from riskloom.plans.shape import rounded
from riskloom.sources import sinks, tables

APP_CLEAN = (
    "app AS (SELECT * REPLACE (nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED,"
    " nullif(CODE_GENDER, 'XNA') AS CODE_GENDER) FROM application)"
)


def clean_application(spark: SparkSession, sf: str) -> DataFrame:
    return tables.clean(spark_view(spark, sf, "application"), tables.TABLES["application_train"])


# -- sources and sinks ----------------------------------------------------------


@query(
    "csv_table_scan",
    with_views("bureau")
    + """
SELECT SK_ID_CURR, SK_ID_BUREAU, CREDIT_ACTIVE, CREDIT_DAY_OVERDUE, DAYS_CREDIT,
  nullif(DAYS_CREDIT_ENDDATE, 365243) AS DAYS_CREDIT_ENDDATE, AMT_CREDIT_SUM,
  AMT_CREDIT_SUM_DEBT, AMT_CREDIT_SUM_OVERDUE, CNT_CREDIT_PROLONG
FROM bureau""",
)
def csv_table_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The loan table written as CSV and loaded through the table registry."""
    path = scratch_path(spark, "bureau") + "/bureau.csv"
    sinks.write_scores(spark_view(spark, sf, "bureau"), path)
    return tables.load_table(spark, "bureau", path=path)


@query(
    "credit_table_sizes",
    """
SELECT 'application_train' AS name, CAST(count(*) AS BIGINT) AS n_rows FROM customer
UNION ALL SELECT 'application_test', count(*) FROM customer
UNION ALL SELECT 'bureau', count(*) FROM orders
UNION ALL SELECT 'bureau_balance', count(*) FROM lineitem
UNION ALL SELECT 'previous_application', count(*) FROM orders
UNION ALL SELECT 'installments_payments', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'pos_cash_balance', count(*) FROM events
UNION ALL SELECT 'credit_card_balance', count(*) FROM events""",
)
def credit_table_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """All eight tables written as CSV files under their own names and loaded back."""
    directory = scratch_path(spark, "raw")
    sources = {
        "application_train": spark_view(spark, sf, "application"),
        "application_test": spark_view(spark, sf, "application").drop("TARGET"),
        **credit_tables(spark, sf),
    }
    for name, rows in sources.items():
        sinks.write_scores(rows, f"{directory}/{tables.TABLES[name].file}")
    out = None
    for name, rows in tables.load_tables(spark, directory).items():
        part = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    assert out is not None
    return out


@query(
    "loan_bridge_scan",
    "SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU FROM orders",
)
def loan_bridge_scan(spark: SparkSession, sf: str) -> DataFrame:
    return tables.loan_bridge(spark_view(spark, sf, "bureau"))


@query(
    "feature_store_roundtrip",
    with_views("application")
    + """
SELECT SK_ID_CURR, AMT_CREDIT, CNT_CHILDREN, CODE_GENDER FROM application""",
)
def feature_store_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "features") + "/train_fe.parquet"
    columns = ["SK_ID_CURR", "AMT_CREDIT", "CNT_CHILDREN", "CODE_GENDER"]
    sinks.write_features(spark_view(spark, sf, "application").select(columns), path)
    return tables.scan(spark, path)


@query(
    "scores_csv_roundtrip",
    "WITH "
    + f"scored AS ({sql_view('scored')})"
    + """
SELECT id, floor(score_a * 1e6 + 0.5) / 1e6 AS predicted_pd,
  CASE WHEN score_a >= 0.5 THEN 1 ELSE 0 END AS decision FROM scored""",
)
def scores_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows through the CSV sink; the file format is inferred from the path."""
    path = scratch_path(spark, "scores") + "/predictions.csv"
    scored = spark_view(spark, sf, "scored").select(
        "id",
        (fx.grid_point(F.col("score_a")) / 1e6).alias("predicted_pd"),
        fx.flag(F.col("score_a") >= 0.5).alias("decision"),
    )
    sinks.write_scores(scored, path)
    return tables.scan(spark, path, ddl="id long, predicted_pd double, decision int")


@query(
    "report_json_roundtrip",
    """
SELECT event_type AS feature, CAST(count(*) AS BIGINT) AS n, round(avg(value), 4) AS mean_value
FROM events GROUP BY event_type""",
)
def report_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report")
    report = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("feature"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean_value"))
    )
    sinks.write_report(report, path)
    return spark.read.schema("feature string, n long, mean_value double").json(path)


@query(
    "narrowed_types",
    """
WITH b AS (
  SELECT 'SK_ID_CURR' AS feature, min(c_custkey) AS lo, max(c_custkey) AS hi FROM customer
  UNION ALL SELECT 'nation', min(c_nationkey), max(c_nationkey) FROM customer
  UNION ALL SELECT 'cents', min(CAST(round(c_acctbal * 100) AS BIGINT)), max(CAST(round(c_acctbal * 100) AS BIGINT)) FROM customer)
SELECT feature, CASE WHEN lo > -128 AND hi < 127 THEN 'tinyint' WHEN lo > -32768 AND hi < 32767 THEN 'smallint'
  WHEN lo > -2147483648 AND hi < 2147483647 THEN 'int' ELSE 'bigint' END AS type FROM b
UNION ALL SELECT 'overdrawn', 'tinyint' UNION ALL SELECT 'balance', 'float' UNION ALL SELECT 'segment', 'string'""",
)
def narrowed_types(spark: SparkSession, sf: str) -> DataFrame:
    """The types chosen by the observed range of every column."""
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        F.col("c_nationkey").alias("nation"),
        F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"),
        (F.col("c_acctbal") < 0).alias("overdrawn"),
        F.col("c_acctbal").cast("double").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    return spark.createDataFrame(sinks.narrow(rows).dtypes, "feature string, type string")


# -- row features -----------------------------------------------------------------


@query(
    "sentinels_to_null",
    with_views("application")
    + """
SELECT SK_ID_CURR, nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED,
  nullif(CODE_GENDER, 'XNA') AS CODE_GENDER FROM application""",
)
def sentinels_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return clean_application(spark, sf).select("SK_ID_CURR", "DAYS_EMPLOYED", "CODE_GENDER")


CREDIT_INCOME_SQL = """
  round(CASE WHEN coalesce(AMT_INCOME_TOTAL, 1) + 1 <> 0 THEN AMT_CREDIT / (coalesce(AMT_INCOME_TOTAL, 1) + 1) END, 6) AS CREDIT_INCOME_RATIO,
  round(CASE WHEN coalesce(AMT_INCOME_TOTAL, 1) + 1 <> 0 THEN AMT_ANNUITY / (coalesce(AMT_INCOME_TOTAL, 1) + 1) END, 6) AS ANNUITY_INCOME_RATIO,
  round(CASE WHEN coalesce(AMT_CREDIT, 1) + 1 <> 0 THEN AMT_ANNUITY / (coalesce(AMT_CREDIT, 1) + 1) END, 6) AS CREDIT_TERM,
  round(CASE WHEN coalesce(AMT_CREDIT, 1) + 1 <> 0 THEN AMT_GOODS_PRICE / (coalesce(AMT_CREDIT, 1) + 1) END, 6) AS GOODS_CREDIT_RATIO,
  round(AMT_INCOME_TOTAL / (coalesce(CNT_FAM_MEMBERS, 1) + 1), 6) AS INCOME_PER_PERSON,
  round(AMT_CREDIT / (coalesce(CNT_FAM_MEMBERS, 1) + 1), 6) AS CREDIT_PER_PERSON,
  AMT_GOODS_PRICE - AMT_CREDIT AS AMT_DOWN_PAYMENT_PROXY"""

AGE_SQL = """
  round(DAYS_BIRTH / -365e0, 6) AS AGE_YEARS,
  round(DAYS_EMPLOYED / -365e0, 6) AS EMPLOYED_YEARS,
  round(DAYS_REGISTRATION / -365e0, 6) AS REGISTRATION_YEARS,
  round(DAYS_ID_PUBLISH / -365e0, 6) AS ID_PUBLISH_YEARS,
  round(DAYS_LAST_PHONE_CHANGE / -365e0, 6) AS LAST_PHONE_CHANGE_YEARS,
  round((DAYS_EMPLOYED / -365e0) / (DAYS_BIRTH / -365e0 + 1), 6) AS EMPLOYED_TO_AGE_RATIO,
  round((DAYS_REGISTRATION / -365e0) / (DAYS_BIRTH / -365e0 + 1), 6) AS REGISTRATION_TO_AGE,
  round((DAYS_ID_PUBLISH / -365e0) / (DAYS_BIRTH / -365e0 + 1), 6) AS ID_TO_AGE_RATIO,
  round(DAYS_BIRTH / -365e0 - DAYS_EMPLOYED / -365e0, 6) AS AGE_AT_EMPLOYMENT_START"""

EXTERNAL_CTE = """
ext_long AS (
  SELECT SK_ID_CURR, EXT_SOURCE_1 AS v FROM app UNION ALL
  SELECT SK_ID_CURR, EXT_SOURCE_2 FROM app UNION ALL
  SELECT SK_ID_CURR, EXT_SOURCE_3 FROM app),
ext AS (
  SELECT SK_ID_CURR, avg(v) AS m, stddev_samp(v) AS s, min(v) AS lo, max(v) AS hi,
    CASE WHEN count(v) >= 1 THEN product(v) END AS p, count(v) AS n
  FROM ext_long GROUP BY SK_ID_CURR)"""

EXTERNAL_SQL = """
  round(m, 6) AS EXT_SOURCE_MEAN, round(s, 6) AS EXT_SOURCE_STD,
  round(lo, 6) AS EXT_SOURCE_MIN, round(hi, 6) AS EXT_SOURCE_MAX,
  round(hi - lo, 6) AS EXT_SOURCE_RANGE, round(p, 6) AS EXT_SOURCE_PRODUCT,
  round((coalesce(EXT_SOURCE_1, m) * 5e-1 + coalesce(EXT_SOURCE_2, m) * 2e0 + coalesce(EXT_SOURCE_3, m) * 15e-1) / 4e0, 6) AS EXT_SOURCE_WEIGHTED,
  CAST(n AS INTEGER) AS EXT_SOURCE_COUNT,
  round(EXT_SOURCE_1 / (EXT_SOURCE_2 + 1e-5), 6) AS EXT_12_RATIO,
  round(EXT_SOURCE_2 / (EXT_SOURCE_3 + 1e-5), 6) AS EXT_23_RATIO,
  round(EXT_SOURCE_1 / (EXT_SOURCE_3 + 1e-5), 6) AS EXT_13_RATIO,
  round(m * (AMT_CREDIT / (coalesce(AMT_INCOME_TOTAL, 1) + 1)), 6) AS EXT_MEAN_X_CREDIT_RATIO,
  CASE WHEN EXT_SOURCE_1 IS NULL THEN 1 ELSE 0 END AS EXT_SOURCE_1_MISSING,
  CASE WHEN EXT_SOURCE_2 IS NULL THEN 1 ELSE 0 END AS EXT_SOURCE_2_MISSING,
  CASE WHEN EXT_SOURCE_3 IS NULL THEN 1 ELSE 0 END AS EXT_SOURCE_3_MISSING"""

_DOC_SUM = " + ".join(f"FLAG_DOCUMENT_{i}" for i in range(2, 11))
SOCIAL_SQL = f"""
  coalesce(DEF_30_CNT_SOCIAL_CIRCLE, 0) + coalesce(DEF_60_CNT_SOCIAL_CIRCLE, 0) AS SOCIAL_CIRCLE_DEFAULT_TOTAL,
  round(coalesce(DEF_30_CNT_SOCIAL_CIRCLE, 0) / (coalesce(OBS_30_CNT_SOCIAL_CIRCLE, 1) + 1), 6) AS SOCIAL_CIRCLE_DEFAULT_RATE,
  (REGION_RATING_CLIENT + REGION_RATING_CLIENT_W_CITY) / 2e0 AS REGION_RATING_MEAN,
  REGION_RATING_CLIENT_W_CITY - REGION_RATING_CLIENT AS REGION_CITY_DIFF,
  CAST({_DOC_SUM} AS BIGINT) AS DOCUMENT_COUNT,
  CASE WHEN {_DOC_SUM} = 0 THEN 1 ELSE 0 END AS DOCUMENT_MISSING,
  CAST(FLAG_MOBIL + FLAG_EMP_PHONE + FLAG_WORK_PHONE + FLAG_CONT_MOBILE + FLAG_PHONE + FLAG_EMAIL AS BIGINT) AS CONTACT_COUNT,
  round(CNT_CHILDREN / (CNT_FAM_MEMBERS + 1), 6) AS CHILDREN_RATIO,
  CASE WHEN CNT_CHILDREN > 0 THEN 1 ELSE 0 END AS HAS_CHILDREN"""

MISSING_SQL = """
  CASE WHEN AMT_GOODS_PRICE IS NULL THEN 1 ELSE 0 END AS AMT_GOODS_PRICE_MISSING,
  CASE WHEN AMT_ANNUITY IS NULL THEN 1 ELSE 0 END AS AMT_ANNUITY_MISSING,
  CASE WHEN OWN_CAR_AGE IS NULL THEN 1 ELSE 0 END AS OWN_CAR_AGE_MISSING,
  CASE WHEN OCCUPATION_TYPE IS NULL THEN 1 ELSE 0 END AS OCCUPATION_TYPE_MISSING,
  CASE WHEN CNT_FAM_MEMBERS IS NULL THEN 1 ELSE 0 END AS CNT_FAM_MEMBERS_MISSING,
  CASE WHEN DAYS_LAST_PHONE_CHANGE IS NULL THEN 1 ELSE 0 END AS DAYS_LAST_PHONE_CHANGE_MISSING,
  coalesce(OWN_CAR_AGE, 0) AS OWN_CAR_AGE"""

APP_WITH = with_views("application") + ",\n" + APP_CLEAN


def _added(after: DataFrame, before: DataFrame) -> list[str]:
    return [c for c in after.columns if c not in before.columns]


@query("credit_income_ratios", f"{APP_WITH} SELECT SK_ID_CURR, {CREDIT_INCOME_SQL} FROM app")
def credit_income_ratios(spark: SparkSession, sf: str) -> DataFrame:
    app = clean_application(spark, sf)
    out = application.credit_income_ratios(app)
    return rounded(out.select("SK_ID_CURR", *_added(out, app)))


@query("age_employment", f"{APP_WITH} SELECT SK_ID_CURR, {AGE_SQL} FROM app")
def age_employment(spark: SparkSession, sf: str) -> DataFrame:
    app = clean_application(spark, sf)
    out = application.age_employment(app)
    return rounded(out.select("SK_ID_CURR", *_added(out, app)))


@query(
    "external_scores",
    f"{APP_WITH}, {EXTERNAL_CTE} SELECT SK_ID_CURR, {EXTERNAL_SQL} FROM app JOIN ext USING (SK_ID_CURR)",
)
def external_scores(spark: SparkSession, sf: str) -> DataFrame:
    app = clean_application(spark, sf)
    out = application.external_scores(app)
    return rounded(out.select("SK_ID_CURR", *_added(out, app)))


@query("social_document", f"{APP_WITH} SELECT SK_ID_CURR, {SOCIAL_SQL} FROM app")
def social_document(spark: SparkSession, sf: str) -> DataFrame:
    app = clean_application(spark, sf)
    out = application.social_document(app)
    return rounded(out.select("SK_ID_CURR", *_added(out, app)))


@query(
    "missing_indicators",
    f"""{APP_WITH} SELECT SK_ID_CURR,
  CASE WHEN EXT_SOURCE_1 IS NULL THEN 1 ELSE 0 END AS EXT_SOURCE_1_MISSING,
  CASE WHEN EXT_SOURCE_3 IS NULL THEN 1 ELSE 0 END AS EXT_SOURCE_3_MISSING,{MISSING_SQL} FROM app""",
)
def missing_indicators(spark: SparkSession, sf: str) -> DataFrame:
    app = clean_application(spark, sf)
    out = application.missing_indicators(app)
    return out.select("SK_ID_CURR", *_added(out, app), "OWN_CAR_AGE")


@query(
    "application_features",
    f"""{APP_WITH}, {EXTERNAL_CTE}
SELECT SK_ID_CURR, {CREDIT_INCOME_SQL},{AGE_SQL},{EXTERNAL_SQL},{SOCIAL_SQL},{MISSING_SQL}
FROM app JOIN ext USING (SK_ID_CURR)""",
)
def application_features(spark: SparkSession, sf: str) -> DataFrame:
    app = clean_application(spark, sf)
    out = application.application_features(app)
    return rounded(out.select("SK_ID_CURR", *_added(out, app), "OWN_CAR_AGE"))


@query(
    "constant_fill",
    with_views("application")
    + """
SELECT SK_ID_CURR, coalesce(OCCUPATION_TYPE, '__missing__') AS OCCUPATION_TYPE,
  coalesce(EXT_SOURCE_1, -999) AS EXT_SOURCE_1 FROM application""",
)
def constant_fill(spark: SparkSession, sf: str) -> DataFrame:
    app = spark_view(spark, sf, "application")
    filled = fx.fill_constant(app, {"OCCUPATION_TYPE": "__missing__", "EXT_SOURCE_1": -999.0})
    return filled.select("SK_ID_CURR", "OCCUPATION_TYPE", "EXT_SOURCE_1")


@query(
    "age_bands",
    with_views("application")
    + """
SELECT SK_ID_CURR, CASE WHEN a > 18 AND a <= 30 THEN '18-30' WHEN a > 30 AND a <= 40 THEN '31-40'
  WHEN a > 40 AND a <= 50 THEN '41-50' WHEN a > 50 AND a <= 60 THEN '51-60'
  WHEN a > 60 AND a <= 100 THEN '60+' END AS AGE_GROUP
FROM (SELECT SK_ID_CURR, -DAYS_BIRTH / 365e0 AS a FROM application)""",
)
def age_bands(spark: SparkSession, sf: str) -> DataFrame:
    app = spark_view(spark, sf, "application")
    return app.select("SK_ID_CURR", age_group(F.col("DAYS_BIRTH")).alias("AGE_GROUP"))


@query(
    "aligned_matrix",
    with_views("application")
    + """
SELECT SK_ID_CURR, CNT_CHILDREN, CAST(NULL AS DOUBLE) AS NOT_THERE, AMT_CREDIT FROM application""",
)
def aligned_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Target and identifiers dropped, then re-ordered to a training column list."""
    app = spark_view(spark, sf, "application")
    x = assemble.drop_columns(app, ["TARGET", "NOT_A_COLUMN"])
    return assemble.align(x, ["SK_ID_CURR", "CNT_CHILDREN", "NOT_THERE", "AMT_CREDIT"])


@query(
    "feature_names_grouped",
    """
WITH names AS (
  SELECT DISTINCT CASE WHEN p_size % 5 = 0 THEN 'BUREAU_' WHEN p_size % 5 = 1 THEN 'CC_'
    WHEN p_size % 5 = 2 THEN 'PREV_' ELSE '' END || upper(p_type) ||
    CASE WHEN p_size % 7 = 0 THEN '_MISSING' ELSE '' END AS feature FROM part
  UNION SELECT 'AGE_YEARS' UNION SELECT 'CREDIT_TERM' UNION SELECT 'DOCUMENT_MISSING')
SELECT feature,
  CASE WHEN feature = 'CREDIT_TERM' THEN 'credit_income_ratios'
       WHEN feature = 'AGE_YEARS' THEN 'age_employment'
       WHEN feature = 'DOCUMENT_MISSING' THEN 'social_document'
       WHEN feature LIKE '%\\_MISSING' ESCAPE '\\' THEN 'missing_indicators'
       WHEN starts_with(feature, 'BUREAU_') THEN 'bureau'
       WHEN starts_with(feature, 'PREV_') THEN 'previous_application'
       WHEN starts_with(feature, 'CC_') THEN 'credit_card' ELSE 'other' END AS feature_group,
  CASE feature WHEN 'AGE_YEARS' THEN 'applicant age' WHEN 'CREDIT_TERM' THEN 'loan repayment term'
       ELSE lower(replace(feature, '_', ' ')) END AS feature_label
FROM names""",
)
def feature_names_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """Feature names derived from the part table, with their group and label."""
    size, kind = F.col("p_size"), F.upper("p_type")
    prefix = (
        F.when(size % 5 == 0, "BUREAU_").when(size % 5 == 1, "CC_").when(size % 5 == 2, "PREV_")
    ).otherwise("")
    suffix = F.when(size % 7 == 0, "_MISSING").otherwise("")
    known = F.explode(F.array(*[F.lit(n) for n in ("AGE_YEARS", "CREDIT_TERM", "DOCUMENT_MISSING")]))
    parts = table(spark, sf, "part")
    names = parts.select(F.concat(prefix, kind, suffix).alias("feature")).union(
        parts.groupBy().agg(F.count(F.lit(1))).select(known.alias("feature"))
    )
    return names.distinct().select(
        "feature",
        feature_group(F.col("feature")).alias("feature_group"),
        feature_label(F.col("feature")).alias("feature_label"),
    )


# -- child profiles ---------------------------------------------------------------


BUREAU_SQL = """
bureau_rows AS (
  SELECT *, CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 ELSE 0 END AS act,
    CASE WHEN CREDIT_DAY_OVERDUE > 0 THEN 1 ELSE 0 END AS od,
    CASE WHEN coalesce(AMT_CREDIT_SUM, 1) = 0 THEN 0e0
         ELSE coalesce(AMT_CREDIT_SUM_DEBT, 0) / coalesce(AMT_CREDIT_SUM, 1) END AS util
  FROM bureau WHERE SK_ID_CURR IS NOT NULL),
bureau_all AS (
  SELECT SK_ID_CURR,
    CAST(count(SK_ID_BUREAU) AS BIGINT) AS BUREAU_LOAN_COUNT,
    CAST(sum(act) AS BIGINT) AS BUREAU_ACTIVE_COUNT,
    CAST(sum(od) AS BIGINT) AS BUREAU_OVERDUE_COUNT,
    CAST(coalesce(sum(CNT_CREDIT_PROLONG), 0) AS BIGINT) AS BUREAU_PROLONG_COUNT,
    round(avg(AMT_CREDIT_SUM), 6) AS BUREAU_CREDIT_SUM_MEAN,
    max(AMT_CREDIT_SUM) AS BUREAU_CREDIT_SUM_MAX,
    coalesce(sum(AMT_CREDIT_SUM), 0) AS BUREAU_CREDIT_SUM_TOTAL,
    round(avg(AMT_CREDIT_SUM_DEBT), 6) AS BUREAU_DEBT_MEAN,
    coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS BUREAU_DEBT_TOTAL,
    max(AMT_CREDIT_SUM_DEBT) AS BUREAU_DEBT_MAX,
    round(avg(AMT_CREDIT_SUM_OVERDUE), 6) AS BUREAU_OVERDUE_AMT_MEAN,
    max(AMT_CREDIT_SUM_OVERDUE) AS BUREAU_OVERDUE_AMT_MAX,
    max(CREDIT_DAY_OVERDUE) AS BUREAU_DAY_OVERDUE_MAX,
    round(avg(CREDIT_DAY_OVERDUE), 6) AS BUREAU_DAY_OVERDUE_MEAN,
    round(avg(util), 6) AS BUREAU_UTILIZATION_MEAN,
    round(max(util), 6) AS BUREAU_UTILIZATION_MAX,
    round(avg(DAYS_CREDIT), 6) AS BUREAU_DAYS_CREDIT_MEAN,
    max(DAYS_CREDIT) AS BUREAU_DAYS_CREDIT_MAX,
    min(DAYS_CREDIT) AS BUREAU_DAYS_CREDIT_MIN
  FROM bureau_rows GROUP BY SK_ID_CURR),
bureau_active AS (
  SELECT SK_ID_CURR,
    coalesce(sum(AMT_CREDIT_SUM_DEBT), 0) AS BUREAU_ACTIVE_DEBT_TOTAL,
    round(avg(AMT_CREDIT_SUM_DEBT), 6) AS BUREAU_ACTIVE_DEBT_MEAN,
    round(avg(AMT_CREDIT_SUM), 6) AS BUREAU_ACTIVE_CREDIT_MEAN,
    max(CREDIT_DAY_OVERDUE) AS BUREAU_ACTIVE_OVERDUE_MAX,
    round(avg(util), 6) AS BUREAU_ACTIVE_UTIL_MEAN
  FROM bureau_rows WHERE act = 1 GROUP BY SK_ID_CURR),
bureau_agg AS (
  SELECT a.*, b.* EXCLUDE (SK_ID_CURR),
    round(BUREAU_ACTIVE_COUNT / BUREAU_LOAN_COUNT, 6) AS BUREAU_ACTIVE_RATIO,
    round(BUREAU_OVERDUE_COUNT / BUREAU_LOAN_COUNT, 6) AS BUREAU_OVERDUE_RATIO,
    round(CASE WHEN BUREAU_CREDIT_SUM_TOTAL = 0 THEN 0e0
      ELSE BUREAU_DEBT_TOTAL / BUREAU_CREDIT_SUM_TOTAL END, 6) AS BUREAU_DEBT_CREDIT_RATIO
  FROM bureau_all a LEFT JOIN bureau_active b ON a.SK_ID_CURR = b.SK_ID_CURR)"""

# Means of short decimal rates: nine digits keep them away from rounding ties.
FINE_MEANS = {
    "BB_STATUS_MEAN_OF_MEANS": 9,
    "BB_DPD_RATE_MEAN": 9,
    "BB_BAD_RATE_MEAN": 9,
    "CC_MIN_PAYMENT_RATIO_MEAN": 9,
}

BALANCE_SQL = """
bb_rows AS (
  SELECT SK_ID_BUREAU, MONTHS_BALANCE,
    CASE STATUS WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 4 WHEN '5' THEN 5 ELSE 0 END AS s
  FROM bureau_balance),
bb_loans AS (
  SELECT SK_ID_BUREAU, count(MONTHS_BALANCE) AS months, avg(s) AS s_mean, max(s) AS s_max,
    sum(CASE WHEN s > 0 THEN 1 ELSE 0 END) AS dpd, sum(CASE WHEN s >= 2 THEN 1 ELSE 0 END) AS bad
  FROM bb_rows GROUP BY SK_ID_BUREAU),
bb_agg AS (
  SELECT b.SK_ID_CURR,
    CAST(count(l.SK_ID_BUREAU) AS BIGINT) AS BB_NUM_BUREAU_CREDITS,
    round(avg(s_mean), 9) AS BB_STATUS_MEAN_OF_MEANS,
    max(s_max) AS BB_STATUS_MAX_EVER,
    CAST(sum(dpd) AS BIGINT) AS BB_TOTAL_DPD_MONTHS,
    CAST(sum(bad) AS BIGINT) AS BB_TOTAL_BAD_MONTHS,
    round(avg(dpd / months), 9) AS BB_DPD_RATE_MEAN,
    round(avg(bad / months), 9) AS BB_BAD_RATE_MEAN,
    round(max(dpd / months), 6) AS BB_DPD_RATE_MAX
  FROM bb_loans l LEFT JOIN bridge b ON l.SK_ID_BUREAU = b.SK_ID_BUREAU
  WHERE b.SK_ID_CURR IS NOT NULL GROUP BY b.SK_ID_CURR)"""

PREVIOUS_SQL = """
prev_rows AS (
  SELECT *, CASE WHEN coalesce(AMT_CREDIT, 1) = 0 THEN 0e0 ELSE AMT_APPLICATION / coalesce(AMT_CREDIT, 1) END AS ratio,
    CASE WHEN coalesce(AMT_GOODS_PRICE, 1) = 0 THEN 0e0
         ELSE coalesce(AMT_DOWN_PAYMENT, 0) / coalesce(AMT_GOODS_PRICE, 1) END AS down
  FROM previous_application),
prev_all AS (
  SELECT SK_ID_CURR,
    CAST(count(SK_ID_PREV) AS BIGINT) AS PREV_APP_COUNT,
    round(avg(AMT_CREDIT), 6) AS PREV_AMT_CREDIT_MEAN, max(AMT_CREDIT) AS PREV_AMT_CREDIT_MAX,
    round(avg(AMT_ANNUITY), 6) AS PREV_AMT_ANNUITY_MEAN,
    round(avg(AMT_APPLICATION), 6) AS PREV_AMT_APPLICATION_MEAN,
    round(avg(ratio), 6) AS PREV_APP_CREDIT_RATIO_MEAN, round(avg(down), 6) AS PREV_DOWN_PAYMENT_MEAN,
    max(DAYS_DECISION) AS PREV_DAYS_DECISION_MAX, round(avg(DAYS_DECISION), 6) AS PREV_DAYS_DECISION_MEAN,
    CAST(sum(CASE WHEN DAYS_DECISION >= -365 THEN 1 ELSE 0 END) AS BIGINT) AS PREV_RECENT_COUNT,
    round(avg(CNT_PAYMENT), 6) AS PREV_CNT_PAYMENT_MEAN
  FROM prev_rows GROUP BY SK_ID_CURR),
prev_ok AS (
  SELECT SK_ID_CURR, CAST(count(SK_ID_PREV) AS BIGINT) AS PREV_APPROVED_COUNT,
    round(avg(AMT_CREDIT), 6) AS PREV_APPROVED_CREDIT_MEAN,
    round(avg(AMT_ANNUITY), 6) AS PREV_APPROVED_ANNUITY_MEAN,
    round(avg(ratio), 6) AS PREV_APPROVED_RATIO_MEAN
  FROM prev_rows WHERE NAME_CONTRACT_STATUS = 'Approved' GROUP BY SK_ID_CURR),
prev_no AS (
  SELECT SK_ID_CURR, CAST(count(SK_ID_PREV) AS BIGINT) AS PREV_REFUSED_COUNT,
    round(avg(AMT_CREDIT), 6) AS PREV_REFUSED_CREDIT_MEAN,
    round(avg(DAYS_DECISION), 6) AS PREV_REFUSED_DAYS_MEAN
  FROM prev_rows WHERE NAME_CONTRACT_STATUS = 'Refused' GROUP BY SK_ID_CURR),
prev_agg AS (
  SELECT a.*, o.* EXCLUDE (SK_ID_CURR), n.* EXCLUDE (SK_ID_CURR),
    round(coalesce(PREV_APPROVED_COUNT, 0) / PREV_APP_COUNT, 6) AS PREV_APPROVAL_RATE,
    round(coalesce(PREV_REFUSED_COUNT, 0) / PREV_APP_COUNT, 6) AS PREV_REFUSAL_RATE
  FROM prev_all a LEFT JOIN prev_ok o ON a.SK_ID_CURR = o.SK_ID_CURR
  LEFT JOIN prev_no n ON a.SK_ID_CURR = n.SK_ID_CURR)"""

INSTALMENT_SQL = """
ins_delay AS (
  SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS d,
    CASE WHEN coalesce(AMT_INSTALMENT, 1) = 0 THEN 0e0
         ELSE coalesce(AMT_PAYMENT, 0) / coalesce(AMT_INSTALMENT, 1) END AS pr,
    AMT_INSTALMENT - coalesce(AMT_PAYMENT, 0) AS pdiff
  FROM installments_payments),
ins_rows AS (
  SELECT *, CASE WHEN d > 0 THEN d WHEN d <= 0 THEN 0e0 END AS late,
    CASE WHEN d < 0 THEN -d WHEN d >= 0 THEN 0e0 END AS early FROM ins_delay),
ins_sums AS (
  SELECT SK_ID_CURR,
    CAST(count(NUM_INSTALMENT_NUMBER) AS BIGINT) AS INS_PAYMENT_COUNT,
    round(avg(late), 6) AS INS_DAYS_LATE_MEAN, max(late) AS INS_DAYS_LATE_MAX,
    coalesce(sum(late), 0) AS INS_DAYS_LATE_SUM, round(avg(early), 6) AS INS_DAYS_EARLY_MEAN,
    CAST(sum(CASE WHEN late > 0 THEN 1 ELSE 0 END) AS BIGINT) AS INS_LATE_COUNT,
    CAST(sum(CASE WHEN late > 30 THEN 1 ELSE 0 END) AS BIGINT) AS INS_VERY_LATE_COUNT,
    CAST(sum(CASE WHEN pr < 95e-2 THEN 1 ELSE 0 END) AS BIGINT) AS INS_UNDERPAID_COUNT,
    round(avg(pr), 6) AS INS_PAYMENT_RATIO_MEAN, round(min(pr), 6) AS INS_PAYMENT_RATIO_MIN,
    round(avg(pdiff), 6) AS INS_PAYMENT_DIFF_MEAN, max(pdiff) AS INS_PAYMENT_DIFF_MAX,
    max(DAYS_ENTRY_PAYMENT) AS INS_DAYS_ENTRY_MAX
  FROM ins_rows GROUP BY SK_ID_CURR),
ins_agg AS (
  SELECT *, round(INS_LATE_COUNT / INS_PAYMENT_COUNT, 6) AS INS_LATE_RATE,
    round(INS_VERY_LATE_COUNT / INS_PAYMENT_COUNT, 6) AS INS_VERY_LATE_RATE,
    round(INS_UNDERPAID_COUNT / INS_PAYMENT_COUNT, 6) AS INS_UNDERPAID_RATE
  FROM ins_sums)"""

POS_SQL = """
pos_sums AS (
  SELECT SK_ID_CURR,
    CAST(count(MONTHS_BALANCE) AS BIGINT) AS POS_MONTHS_COUNT,
    round(avg(SK_DPD), 6) AS POS_SK_DPD_MEAN, max(SK_DPD) AS POS_SK_DPD_MAX,
    CAST(sum(SK_DPD) AS BIGINT) AS POS_SK_DPD_SUM,
    round(avg(SK_DPD_DEF), 6) AS POS_SK_DPD_DEF_MEAN, max(SK_DPD_DEF) AS POS_SK_DPD_DEF_MAX,
    CAST(sum(CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END) AS BIGINT) AS POS_DPD_MONTH_COUNT,
    CAST(sum(CASE WHEN SK_DPD_DEF > 0 THEN 1 ELSE 0 END) AS BIGINT) AS POS_DPD_DEF_COUNT,
    CAST(sum(CASE WHEN NAME_CONTRACT_STATUS = 'Completed' THEN 1 ELSE 0 END) AS BIGINT) AS POS_COMPLETED_COUNT,
    CAST(sum(CASE WHEN NAME_CONTRACT_STATUS = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS POS_ACTIVE_COUNT,
    round(avg(CNT_INSTALMENT), 6) AS POS_CNT_INSTALMENT_MEAN,
    round(avg(CNT_INSTALMENT_FUTURE), 6) AS POS_CNT_INSTALMENT_FUTURE_MEAN
  FROM pos_cash_balance GROUP BY SK_ID_CURR),
pos_agg AS (
  SELECT *, round(POS_DPD_MONTH_COUNT / POS_MONTHS_COUNT, 6) AS POS_DPD_RATE,
    round(POS_COMPLETED_COUNT / POS_MONTHS_COUNT, 6) AS POS_COMPLETED_RATE FROM pos_sums)"""

CARD_SQL = """
cc_rows AS (
  SELECT *, CASE WHEN coalesce(AMT_CREDIT_LIMIT_ACTUAL, 1) = 0 THEN 0e0
      ELSE greatest(least(coalesce(AMT_BALANCE, 0) / coalesce(AMT_CREDIT_LIMIT_ACTUAL, 1), 1e0), 0e0) END AS u,
    CASE WHEN coalesce(AMT_INST_MIN_REGULARITY, 1) = 0 THEN 0e0
      ELSE coalesce(AMT_PAYMENT_CURRENT, 0) / coalesce(AMT_INST_MIN_REGULARITY, 1) END AS mp,
    coalesce(AMT_DRAWINGS_ATM_CURRENT, 0) + coalesce(AMT_DRAWINGS_CURRENT, 0)
      + coalesce(AMT_DRAWINGS_OTHER_CURRENT, 0) + coalesce(AMT_DRAWINGS_POS_CURRENT, 0) AS drawn
  FROM credit_card_balance),
cc_sums AS (
  SELECT SK_ID_CURR,
    CAST(count(MONTHS_BALANCE) AS BIGINT) AS CC_MONTHS_COUNT,
    round(avg(u), 6) AS CC_UTILIZATION_MEAN, round(max(u), 6) AS CC_UTILIZATION_MAX,
    round(min(u), 6) AS CC_UTILIZATION_MIN,
    round(avg(AMT_BALANCE), 6) AS CC_AMT_BALANCE_MEAN, max(AMT_BALANCE) AS CC_AMT_BALANCE_MAX,
    round(avg(AMT_PAYMENT_CURRENT), 6) AS CC_PAYMENT_MEAN,
    round(avg(mp), 9) AS CC_MIN_PAYMENT_RATIO_MEAN, round(avg(drawn), 6) AS CC_DRAWING_TOTAL_MEAN,
    round(avg(coalesce(AMT_DRAWINGS_ATM_CURRENT, 0) / nullif(drawn, 0)), 6) AS CC_CASH_DRAW_RATIO_MEAN,
    round(avg(SK_DPD), 6) AS CC_DPD_MEAN, max(SK_DPD) AS CC_DPD_MAX,
    CAST(sum(CASE WHEN SK_DPD > 0 THEN 1 ELSE 0 END) AS BIGINT) AS CC_DPD_MONTH_COUNT,
    CAST(sum(CASE WHEN u > 95e-2 THEN 1 ELSE 0 END) AS BIGINT) AS CC_MAXED_COUNT,
    round(avg(AMT_CREDIT_LIMIT_ACTUAL), 6) AS CC_LIMIT_MEAN,
    max(AMT_CREDIT_LIMIT_ACTUAL) AS CC_LIMIT_MAX
  FROM cc_rows GROUP BY SK_ID_CURR),
cc_agg AS (
  SELECT *, round(CC_DPD_MONTH_COUNT / CC_MONTHS_COUNT, 6) AS CC_DPD_RATE,
    round(CC_MAXED_COUNT / CC_MONTHS_COUNT, 6) AS CC_MAXED_RATE FROM cc_sums)"""


@query("bureau_profile", with_views("bureau") + f", {BUREAU_SQL} SELECT * FROM bureau_agg")
def bureau_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(children.bureau_profile(spark_view(spark, sf, "bureau")))


@query(
    "bureau_balance_profile",
    with_views("bureau_balance", "bridge") + f", {BALANCE_SQL} SELECT * FROM bb_agg",
)
def bureau_balance_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        children.bureau_balance_profile(
            spark_view(spark, sf, "bureau_balance"), spark_view(spark, sf, "bridge")
        ),
        finer=FINE_MEANS,
    )


@query(
    "previous_profile",
    with_views("previous_application") + f", {PREVIOUS_SQL} SELECT * FROM prev_agg",
)
def previous_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(children.previous_profile(spark_view(spark, sf, "previous_application")))


@query(
    "installments_profile",
    with_views("installments_payments") + f", {INSTALMENT_SQL} SELECT * FROM ins_agg",
)
def installments_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(children.installments_profile(spark_view(spark, sf, "installments_payments")))


@query("pos_cash_profile", with_views("pos_cash_balance") + f", {POS_SQL} SELECT * FROM pos_agg")
def pos_cash_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(children.pos_cash_profile(spark_view(spark, sf, "pos_cash_balance")))


@query(
    "credit_card_profile", with_views("credit_card_balance") + f", {CARD_SQL} SELECT * FROM cc_agg"
)
def credit_card_profile(spark: SparkSession, sf: str) -> DataFrame:
    cards = spark_view(spark, sf, "credit_card_balance")
    return rounded(children.credit_card_profile(cards), finer=FINE_MEANS)


CHILD_VIEWS = (
    "bureau",
    "bureau_balance",
    "previous_application",
    "installments_payments",
    "pos_cash_balance",
    "credit_card_balance",
)


def credit_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: spark_view(spark, sf, name) for name in CHILD_VIEWS}


@query(
    "full_feature_matrix",
    with_views("application", *CHILD_VIEWS)
    + f""",
bridge AS (SELECT SK_ID_CURR, SK_ID_BUREAU FROM bureau),
{APP_CLEAN}, {EXTERNAL_CTE}, {BUREAU_SQL}, {BALANCE_SQL}, {PREVIOUS_SQL}, {INSTALMENT_SQL},
{POS_SQL}, {CARD_SQL},
row_features AS (
  SELECT SK_ID_CURR, {CREDIT_INCOME_SQL},{AGE_SQL},{EXTERNAL_SQL},{SOCIAL_SQL},{MISSING_SQL}
  FROM app JOIN ext USING (SK_ID_CURR))
SELECT f.*, b1.* EXCLUDE (SK_ID_CURR), b2.* EXCLUDE (SK_ID_CURR), b3.* EXCLUDE (SK_ID_CURR),
  b4.* EXCLUDE (SK_ID_CURR), b5.* EXCLUDE (SK_ID_CURR), b6.* EXCLUDE (SK_ID_CURR)
FROM row_features f
LEFT JOIN bureau_agg b1 ON f.SK_ID_CURR = b1.SK_ID_CURR
LEFT JOIN bb_agg b2 ON f.SK_ID_CURR = b2.SK_ID_CURR
LEFT JOIN prev_agg b3 ON f.SK_ID_CURR = b3.SK_ID_CURR
LEFT JOIN ins_agg b4 ON f.SK_ID_CURR = b4.SK_ID_CURR
LEFT JOIN pos_agg b5 ON f.SK_ID_CURR = b5.SK_ID_CURR
LEFT JOIN cc_agg b6 ON f.SK_ID_CURR = b6.SK_ID_CURR""",
)
def full_feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Application features joined to all six child profiles (raw inputs excluded)."""
    raw = [c for c in spark_view(spark, sf, "application").columns if c != "SK_ID_CURR"]
    raw.remove("OWN_CAR_AGE")
    out = assemble.build_features(
        clean_application(spark, sf), credit_tables(spark, sf), exclude=raw
    )
    return rounded(out, finer=FINE_MEANS)


@query(
    "active_credit_ratio",
    with_views("bureau")
    + """, agg AS (
  SELECT SK_ID_CURR, count(SK_ID_BUREAU) AS n,
    sum(CASE WHEN CREDIT_ACTIVE = 'Active' THEN 1 ELSE 0 END) AS act,
    sum(CASE WHEN CREDIT_ACTIVE = 'Active' THEN AMT_CREDIT_SUM END) AS act_sum
  FROM bureau GROUP BY SK_ID_CURR)
SELECT c_custkey AS SK_ID_CURR, CAST(n AS BIGINT) AS loan_count, act_sum AS active_credit,
  round(act / n, 6) AS active_ratio,
  round(act_sum / (coalesce(c_acctbal, 1) + 1), 6) AS active_to_income,
  CASE WHEN n IS NULL THEN 1 ELSE 0 END AS no_history
FROM customer LEFT JOIN agg ON c_custkey = SK_ID_CURR""",
)
def active_credit_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Smallest end-to-end slice: conditional aggregate, left join, guarded ratios."""
    profile = children.Profile(
        derived=[{"_active": lambda: fx.flag(F.col("CREDIT_ACTIVE") == "Active")}],
        measures=[
            children.Measure("loan_count", "count", "SK_ID_BUREAU"),
            children.Measure("_active_count", "sum", "_active"),
            children.Measure("active_credit", "sum", "_credit", "_known"),
        ],
    )
    loans = spark_view(spark, sf, "bureau").withColumns(
        {
            "_credit": F.col("AMT_CREDIT_SUM"),
            "_known": fx.flag(
                (F.col("CREDIT_ACTIVE") == "Active") & F.col("AMT_CREDIT_SUM").isNotNull()
            ),
        }
    )
    base = table(spark, sf, "customer").select(F.col("c_custkey").alias("SK_ID_CURR"), "c_acctbal")
    joined = assemble.assemble(base, [children.profile_children(loans, profile)])
    ratio = fx.guarded_ratio(F.col("_active_count"), F.col("loan_count"))
    income = fx.ratio_over_one_plus(F.col("active_credit"), F.col("c_acctbal"))
    return joined.select(
        "SK_ID_CURR",
        "loan_count",
        "active_credit",
        F.round(ratio, 6).alias("active_ratio"),
        F.round(income, 6).alias("active_to_income"),
        fx.flag(F.col("loan_count").isNull()).alias("no_history"),
    )


# -- joins --------------------------------------------------------------------------


@query(
    "checked_demographics_join",
    """
SELECT o_orderkey, o_custkey AS c_custkey, c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def checked_demographics_join(spark: SparkSession, sf: str) -> DataFrame:
    loans = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    people = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return checked_left_join(loans, people, "c_custkey").select(
        "o_orderkey", "c_custkey", "c_mktsegment"
    )


@query(
    "applicants_without_records",
    """
SELECT CAST(count(*) AS BIGINT) AS n_parents,
  CAST(count(*) FILTER (c_custkey NOT IN (SELECT user_id FROM events)) AS BIGINT) AS n_without_children
FROM customer""",
)
def applicants_without_records(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    records = table(spark, sf, "events").select(F.col("user_id").alias("key"))
    return count_without_children(people, records, "key")


@query(
    "guarded_part_statistics",
    """
WITH p AS (SELECT p_partkey, nullif(p_size, 1) AS a, p_retailprice / 997e0 AS b,
    CASE WHEN p_size > 40 THEN NULL ELSE p_size % 3 END AS c FROM part),
l AS (SELECT p_partkey, CAST(a AS DOUBLE) AS v FROM p UNION ALL SELECT p_partkey, b FROM p
      UNION ALL SELECT p_partkey, CAST(c AS DOUBLE) FROM p),
s AS (SELECT p_partkey, avg(v) AS m, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi,
        product(v) AS pr, count(v) AS n FROM l GROUP BY p_partkey)
SELECT p.p_partkey, CAST(n AS INTEGER) AS n, round(m, 6) AS row_mean, round(sd, 6) AS row_std,
  round(lo, 6) AS row_min, round(hi, 6) AS row_max, round(pr, 6) AS row_product,
  round(CASE WHEN c = 0 THEN 0e0 ELSE a / c END, 6) AS a_over_c,
  round((coalesce(a, m) * 5e-1 + coalesce(b, m) * 2e0 + coalesce(c, m) * 15e-1) / 4e0, 6) AS weighted
FROM p JOIN s ON p.p_partkey = s.p_partkey""",
)
def guarded_part_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """The row-wise operators on another schema: all of them take columns as arguments."""
    size = F.col("p_size")
    rows = table(spark, sf, "part").select(
        "p_partkey",
        F.nullif(size, F.lit(1)).alias("a"),
        (F.col("p_retailprice") / 997.0).alias("b"),
        F.when(size <= 40, size % 3).alias("c"),
    )
    group = [F.col("a"), F.col("b"), F.col("c")]
    doubles = [c.cast("double") for c in group]
    return rounded(
        rows.select(
            "p_partkey",
            fx.row_count(group).alias("n"),
            fx.row_mean(group).alias("row_mean"),
            fx.row_std(doubles).alias("row_std"),
            fx.row_min(doubles).alias("row_min"),
            fx.row_max(doubles).alias("row_max"),
            fx.row_product(group).alias("row_product"),
            fx.guarded_ratio(F.col("a"), F.col("c")).alias("a_over_c"),
            fx.weighted_row_mean(group, [0.5, 2.0, 1.5], 4.0).alias("weighted"),
        )
    )

