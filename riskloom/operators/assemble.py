"""The full feature matrix: application features left-joined to every child profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import children
from riskloom.operators.application import application_features
from riskloom.sources.tables import loan_bridge

KEY, TARGET = "SK_ID_CURR", "TARGET"


def child_profiles(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The six per-applicant aggregates, in join order."""
    bureau = tables["bureau"]
    return [
        children.bureau_profile(bureau),
        children.bureau_balance_profile(tables["bureau_balance"], loan_bridge(bureau)),
        children.previous_profile(tables["previous_application"]),
        children.installments_profile(tables["installments_payments"]),
        children.pos_cash_profile(tables["pos_cash_balance"]),
        children.credit_card_profile(tables["credit_card_balance"]),
    ]


def assemble(
    base: DataFrame,
    aggregates: Sequence[DataFrame],
    key: str = KEY,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Left-join one-row-per-key aggregates; all sides share one hash partitioning."""
    out = base
    for aggregate in aggregates:
        out = out.join(aggregate, key, "left")
    return out.drop(*exclude)


def build_features(
    application: DataFrame, tables: Mapping[str, DataFrame], exclude: Sequence[str] = ()
) -> DataFrame:
    return assemble(application_features(application), child_profiles(tables), KEY, exclude)


def build_feature_pair(
    train: DataFrame,
    test: DataFrame,
    tables: Mapping[str, DataFrame],
    exclude: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    return build_features(train, tables, exclude), build_features(test, tables, exclude)


def align(df: DataFrame, columns: Sequence[str], types: Mapping[str, str] | None = None) -> DataFrame:
    """Exactly these columns in this order; an absent one is a typed NULL."""
    types = types or {}
    return df.select(
        [
            F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "double")).alias(c)
            for c in columns
        ]
    )


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def split_target(
    train: DataFrame, test: DataFrame, key: str = KEY, target: str = TARGET
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Features, (key, target) labels and the test features in training column order.

    The key stays with every part: rows are matched by key, never by position.
    """
    x = drop_columns(train, [target])
    x_types = {f.name: f.dataType.simpleString() for f in x.schema.fields}
    return x, train.select(key, target), align(test, x.columns, x_types)
