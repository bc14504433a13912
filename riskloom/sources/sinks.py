"""Sinks for features, scores and reports, and type narrowing before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds a column must stay strictly inside to be narrowed.
INTEGER_BOUNDS = (
    ("tinyint", -(2**7), 2**7 - 1),
    ("smallint", -(2**15), 2**15 - 1),
    ("int", -(2**31), 2**31 - 1),
)
FLOAT_MAX = 3.4028234663852886e38


def narrowed_types(df: DataFrame) -> dict[str, str]:
    """Smallest type holding each numeric column, from one aggregate over the table."""
    integers = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    ]
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    chosen = {c: "tinyint" for c in flags}
    if not integers and not doubles:
        return chosen
    aggs = [
        fn(c).alias(f"{tag}__{c}")
        for c in integers + doubles
        for tag, fn in (("lo", F.min), ("hi", F.max))
    ]
    bounds = df.agg(*aggs).first()
    assert bounds is not None
    for c in integers:
        low, high = bounds[f"lo__{c}"], bounds[f"hi__{c}"]
        if low is None:
            continue
        for name, least, most in INTEGER_BOUNDS:
            if low > least and high < most:
                chosen[c] = name
                break
    for c in doubles:
        low, high = bounds[f"lo__{c}"], bounds[f"hi__{c}"]
        if low is not None and low > -FLOAT_MAX and high < FLOAT_MAX:
            chosen[c] = "float"
    return chosen


def narrow(df: DataFrame, floats: bool = True) -> DataFrame:
    """Cast to the narrowed types. Nullable integers stay integers."""
    chosen = narrowed_types(df)
    if not floats:
        chosen = {c: t for c, t in chosen.items() if t != "float"}
    return df.select([F.col(c).cast(chosen[c]).alias(c) if c in chosen else c for c in df.columns])


def write_features(df: DataFrame, path: str, narrow_types: bool = False) -> None:
    (narrow(df) if narrow_types else df).write.mode("overwrite").parquet(path)


def write_scores(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """Reports are tall tables: one JSON object per row."""
    df.write.mode("overwrite").json(path)
