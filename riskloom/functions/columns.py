"""Column helpers that keep the null rules of the credit features.

Spark runs with ANSI mode on, so every division here is guarded: an unguarded
zero divisor would abort the job instead of giving a missing value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The day sentinel and the columns known to carry it.
DAY_SENTINEL = 365243
DAY_SENTINEL_COLUMNS = (
    "DAYS_EMPLOYED",
    "DAYS_CREDIT_ENDDATE",
    "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
    "DAYS_ENTRY_PAYMENT",
    "DAYS_INSTALMENT",
)

FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)


def column_or_null(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """The column, or a typed NULL when the table does not carry it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def columns_of_type(df: DataFrame, *types: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.NumericType)


def string_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.StringType)


# -- missing values -----------------------------------------------------------


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark orders NaN above every number, so a stray NaN becomes NULL at the scan."""
    names = columns_of_type(df, T.DoubleType, T.FloatType)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names}) if names else df


def sentinel_to_null(
    df: DataFrame, columns: Sequence[str] | None = None, value: float | str = DAY_SENTINEL
) -> DataFrame:
    present = [c for c in (columns or DAY_SENTINEL_COLUMNS) if c in df.columns]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(value)) for c in present}) if present else df


def missing_flags(df: DataFrame, columns: Sequence[str], suffix: str = "_MISSING") -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({f"{c}{suffix}": flag(F.col(c).isNull()) for c in present})


def fill_constant(df: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


# -- scalar rules -------------------------------------------------------------


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Zero over a zero divisor (whatever the numerator), NULL over a missing one."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        F.try_divide(numerator.cast("double"), denominator.cast("double"))
    )


def ratio_over_one_plus(numerator: Column, denominator: Column) -> Column:
    """numerator / (1 + denominator), a missing denominator counting as one."""
    return F.try_divide(
        numerator.cast("double"), F.coalesce(denominator.cast("double"), F.lit(1.0)) + 1.0
    )


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0).cast("double"))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip that keeps NULL; least/greatest alone would replace it by the bound."""
    out = value
    if high is not None:
        out = F.least(out, F.lit(high))
    if low is not None:
        out = F.greatest(out, F.lit(low))
    return F.when(value.isNotNull(), out)


def positive_part(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(value.cast("double"), F.lit(0.0)))


def negative_part(value: Column) -> Column:
    """How far below zero the value is; never gives minus zero."""
    return F.when(value < 0, -value.cast("double")).when(value.isNotNull(), F.lit(0.0))


def code_map(value: Column, codes: Mapping[str, int], default: int = 0) -> Column:
    """Fixed code table as one CASE expression; unknown and missing give the default."""
    out: Column | None = None
    for key, code in codes.items():
        out = F.when(value == key, code) if out is None else out.when(value == key, code)
    assert out is not None
    return out.otherwise(default)


def band_right_closed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (low, high] holding the value, NULL outside all of them."""
    out: Column | None = None
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = (value > low) & (value <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    assert out is not None
    return out


def band_below(value: Column, limits: Sequence[tuple[float, str]], last: str) -> Column:
    """First label whose limit lies above the value; NULL stays NULL."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, label in limits:
        out = out.when(value < limit, label)
    return out.otherwise(last)


def left_open_bin(value: Column, bins: int, low: float = 0.0, high: float = 1.0) -> Column:
    """Uniform bin number counting inner edges strictly below the value."""
    edges = [low + (high - low) * i / bins for i in range(1, bins)]
    return reduce(add, [flag(value > e) for e in edges], F.lit(0))


def sigmoid(value: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-value))


def grid_point(value: Column, digits: int = 6) -> Column:
    """Half-up rounding onto a fixed grid as a long; cheaper than decimal rounding."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("long")


# -- row-wise statistics over a column group ----------------------------------


def total(parts: Sequence[Column]) -> Column:
    return reduce(add, parts)


def row_count(columns: Sequence[Column]) -> Column:
    return total([flag(c.isNotNull()) for c in columns])


def row_mean(columns: Sequence[Column]) -> Column:
    filled = total([F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])
    return F.try_divide(filled, row_count(columns).cast("double"))


def row_std(columns: Sequence[Column]) -> Column:
    """Sample deviation of the non-null values, NULL below two of them."""
    mean = row_mean(columns)
    squares = total([F.coalesce(F.pow(c - mean, F.lit(2.0)), F.lit(0.0)) for c in columns])
    return F.when(row_count(columns) >= 2, F.sqrt(squares / (row_count(columns) - 1)))


def row_min(columns: Sequence[Column]) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def row_max(columns: Sequence[Column]) -> Column:
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def row_product(columns: Sequence[Column]) -> Column:
    product = reduce(mul, [F.coalesce(c.cast("double"), F.lit(1.0)) for c in columns])
    return F.when(row_count(columns) >= 1, product)


def weighted_row_mean(
    columns: Sequence[Column], weights: Sequence[float], divisor: float
) -> Column:
    """Weighted sum over a fixed divisor, gaps filled by the row mean."""
    mean = row_mean(columns)
    parts = [F.coalesce(c.cast("double"), mean) * w for c, w in zip(columns, weights, strict=True)]
    return total(parts) / divisor
