"""Feature names: which group a feature belongs to and what to call it for a reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Group name -> exact names, prefixes (ending in "_") and suffixes
# (starting with "_"). The first group that matches wins.
FEATURE_GROUPS: dict[str, tuple[str, ...]] = {
    "credit_income_ratios": (
        "CREDIT_INCOME_RATIO",
        "ANNUITY_INCOME_RATIO",
        "CREDIT_TERM",
        "GOODS_CREDIT_RATIO",
        "INCOME_PER_PERSON",
        "CREDIT_PER_PERSON",
        "AMT_DOWN_PAYMENT_PROXY",
    ),
    "age_employment": (
        "AGE_YEARS",
        "EMPLOYED_YEARS",
        "REGISTRATION_YEARS",
        "ID_PUBLISH_YEARS",
        "LAST_PHONE_CHANGE_YEARS",
        "EMPLOYED_TO_AGE_RATIO",
        "REGISTRATION_TO_AGE",
        "ID_TO_AGE_RATIO",
        "AGE_AT_EMPLOYMENT_START",
    ),
    "ext_source": (
        "EXT_SOURCE_MEAN",
        "EXT_SOURCE_STD",
        "EXT_SOURCE_MIN",
        "EXT_SOURCE_MAX",
        "EXT_SOURCE_RANGE",
        "EXT_SOURCE_PRODUCT",
        "EXT_SOURCE_WEIGHTED",
        "EXT_SOURCE_COUNT",
        "EXT_12_RATIO",
        "EXT_23_RATIO",
        "EXT_13_RATIO",
        "EXT_MEAN_X_CREDIT_RATIO",
    ),
    "social_document": (
        "SOCIAL_CIRCLE_DEFAULT_TOTAL",
        "SOCIAL_CIRCLE_DEFAULT_RATE",
        "REGION_RATING_MEAN",
        "REGION_CITY_DIFF",
        "DOCUMENT_COUNT",
        "DOCUMENT_MISSING",
        "CONTACT_COUNT",
        "CHILDREN_RATIO",
        "HAS_CHILDREN",
    ),
    "missing_indicators": ("_MISSING",),
    "bureau": ("BUREAU_",),
    "bureau_balance": ("BB_",),
    "previous_application": ("PREV_",),
    "installments": ("INS_",),
    "pos_cash": ("POS_",),
    "credit_card": ("CC_",),
}

# Wording of the reasons shown to an applicant.
FEATURE_LABELS: dict[str, str] = {
    "CREDIT_INCOME_RATIO": "credit amount relative to income",
    "ANNUITY_INCOME_RATIO": "monthly repayment relative to income",
    "CREDIT_TERM": "loan repayment term",
    "DAYS_EMPLOYED_RATIO": "employment stability relative to age",
    "DAYS_EMPLOYED_ANOM": "employment history availability",
    "AGE_YEARS": "applicant age",
    "INCOME_PER_PERSON": "income per household member",
    "GOODS_CREDIT_RATIO": "goods value relative to credit amount",
    "EXT_SOURCE_1": "external credit score 1",
    "EXT_SOURCE_2": "external credit score 2",
    "EXT_SOURCE_3": "external credit score 3",
    "DAYS_BIRTH": "applicant age",
    "DAYS_EMPLOYED": "employment duration",
    "AMT_CREDIT": "loan amount",
    "AMT_INCOME_TOTAL": "total annual income",
}


def feature_group(name: Column, groups: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Group of a feature-name column as one CASE expression, ``other`` if none fits."""
    out: Column | None = None
    for group, patterns in (groups or FEATURE_GROUPS).items():
        exact = [p for p in patterns if not (p.endswith("_") or p.startswith("_"))]
        tests = [name.startswith(p) for p in patterns if p.endswith("_")]
        tests += [name.endswith(p) for p in patterns if p.startswith("_")]
        if exact:
            tests.append(name.isin(*exact))
        for test in tests:
            out = F.when(test, group) if out is None else out.when(test, group)
    assert out is not None
    return out.otherwise("other")


def group_columns(spark: SparkSession, columns: Sequence[str]) -> dict[str, list[str]]:
    """Schema-level split of column names by group (metadata only, one row per column)."""
    rows = (
        spark.createDataFrame([(i, c) for i, c in enumerate(columns)], "pos int, feature string")
        .select("pos", "feature", feature_group(F.col("feature")).alias("grp"))
        .orderBy("pos")
        .collect()
    )
    out: dict[str, list[str]] = {}
    for row in rows:
        out.setdefault(row["grp"], []).append(row["feature"])
    return out


def feature_label(name: Column, labels: dict[str, str] | None = None) -> Column:
    """Reader-facing wording; unknown names are lower-cased with spaces."""
    table = labels or FEATURE_LABELS
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    fallback = F.lower(F.regexp_replace(name, "_", " "))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), fallback)


def capitalize_first(text: Column) -> Column:
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.right(text, F.length(text) - 1)))


def attach_groups(df: DataFrame, feature: str = "feature") -> DataFrame:
    return df.withColumn("feature_group", feature_group(F.col(feature)))
