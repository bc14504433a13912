"""Turning wide tables into tall ones and one-row summaries into reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tall(
    df: DataFrame,
    columns: Sequence[str],
    ids: Sequence[str] = (),
    name: str = "feature",
    value: str = "value",
    dtype: str = "double",
) -> DataFrame:
    """One row per (row, column): a narrow Expand, no shuffle."""
    typed = df.selectExpr(
        *[f"`{c}`" for c in ids], *[f"CAST(`{c}` AS {dtype}) AS `{c}`" for c in columns]
    )
    return typed.unpivot(list(ids), list(columns), name, value)


def report_rows(
    df: DataFrame, features: Sequence[str], stats: Mapping[str, str], name: str = "feature"
) -> DataFrame:
    """Spread a one-row table with ``<stat>__<feature>`` columns into one row per feature.

    ``stats`` maps each statistic to its output type.
    """
    entries = [
        f"struct('{f}' AS `{name}`, "
        + ", ".join(f"CAST(`{s}__{f}` AS {t}) AS `{s}`" for s, t in stats.items())
        + ")"
        for f in features
    ]
    return df.selectExpr(f"inline(array({', '.join(entries)}))")


def summarise(
    df: DataFrame,
    features: Sequence[str],
    measures: Mapping[str, tuple[str, Callable[[str], str]]],
) -> DataFrame:
    """Aggregate every feature in one pass and return one row per feature.

    ``measures`` maps a statistic to its type and to a function giving the SQL of the
    aggregate for a quoted column.
    """
    aggs = [
        F.expr(f"{sql(f'`{f}`')} AS `{s}__{f}`")
        for f in features
        for s, (_, sql) in measures.items()
    ]
    return report_rows(df.agg(*aggs), features, {s: t for s, (t, _) in measures.items()})


def rounded(
    df: DataFrame, digits: int = 6, finer: Mapping[str, int] | None = None
) -> DataFrame:
    """Round the double columns for a report; other columns pass through."""
    finer = finer or {}
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.selectExpr(
        *[
            f"round(`{c}`, {finer.get(c, digits)}) AS `{c}`" if c in doubles else f"`{c}`"
            for c in df.columns
        ]
    )
