import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import columns as fx
from riskloom.functions.naming import feature_group, feature_label, group_columns


def values(df, name):
    return [r[name] for r in df.collect()]


def test_guarded_ratio(spark):
    rows = [(1.0, 0.0), (None, 0.0), (1.0, None), (4.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert values(df.select(fx.guarded_ratio(F.col("a"), F.col("b")).alias("r")), "r") == [
        0.0,
        0.0,
        None,
        2.0,
    ]


def test_ratio_over_one_plus_missing_and_minus_one(spark):
    df = spark.createDataFrame([(6.0, None), (6.0, 2.0), (6.0, -1.0)], "a double, b double")
    out = df.select(fx.ratio_over_one_plus(F.col("a"), F.col("b")).alias("r"))
    assert values(out, "r") == [3.0, 2.0, None]


def test_flag_and_parts_of_missing(spark):
    df = spark.createDataFrame([(5.0,), (-3.0,), (0.0,), (None,)], "d double")
    out = df.select(
        fx.flag(F.col("d") > 0).alias("f"),
        fx.positive_part(F.col("d")).alias("late"),
        fx.negative_part(F.col("d")).alias("early"),
        fx.clip(F.col("d"), 0.0, 1.0).alias("c"),
    ).collect()
    assert [tuple(r) for r in out] == [
        (1, 5.0, 0.0, 1.0),
        (0, 0.0, 3.0, 0.0),
        (0, 0.0, 0.0, 0.0),
        (0, None, None, None),
    ]
    assert math.copysign(1, out[0]["early"]) == 1


def test_sentinel_and_nan(spark):
    df = spark.createDataFrame(
        [(365243, float("nan")), (0, 1.0), (-100, 2.0), (365243, None)],
        "DAYS_EMPLOYED int, x double",
    )
    out = fx.sentinel_to_null(fx.nan_to_null(df))
    assert values(out, "DAYS_EMPLOYED") == [None, 0, -100, None]
    assert values(out, "x") == [None, 1.0, 2.0, None]


def test_row_statistics_skip_missing(spark):
    rows = [(1.0, 2.0, 4.0), (None, 2.0, 4.0), (None, None, 4.0), (None, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    group = [F.col("a"), F.col("b"), F.col("c")]
    out = df.select(
        fx.row_count(group).alias("n"),
        fx.row_mean(group).alias("mean"),
        fx.row_std(group).alias("std"),
        fx.row_product(group).alias("prod"),
    ).collect()
    assert [r["n"] for r in out] == [3, 2, 1, 0]
    assert [r["mean"] for r in out] == [pytest.approx(7 / 3), 3.0, 4.0, None]
    assert out[0]["std"] == pytest.approx(1.5275252)
    assert out[1]["std"] == pytest.approx(math.sqrt(2))
    assert out[2]["std"] is None and out[3]["std"] is None
    assert [r["prod"] for r in out] == [8.0, 8.0, 4.0, None]


def test_bands(spark):
    df = spark.createDataFrame([(18.0,), (18.1,), (30.0,), (100.0,), (101.0,), (None,)], "a double")
    out = df.select(
        fx.band_right_closed(F.col("a"), (18.0, 30.0, 100.0), ("young", "old")).alias("b")
    )
    assert values(out, "b") == [None, "young", "young", "old", None, None]
    psi = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (None,)], "p double")
    limits = ((0.10, "stable"), (0.20, "moderate"))
    bands = psi.select(fx.band_below(F.col("p"), limits, "major").alias("b"))
    assert values(bands, "b") == ["stable", "moderate", "major", None]


def test_code_map(spark):
    df = spark.createDataFrame([("C",), ("3",), ("?",), (None,)], "s string")
    out = df.select(fx.code_map(F.col("s"), {"C": 0, "3": 3}).alias("c"))
    assert values(out, "c") == [0, 3, 0, 0]


def test_left_open_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.10001,), (1.0,)], "p double")
    assert values(df.select(fx.left_open_bin(F.col("p"), 10).alias("b")), "b") == [0, 0, 1, 9]


def test_feature_groups_first_match_wins(spark):
    names = ["DOCUMENT_MISSING", "X_MISSING", "BUREAU_X_MISSING", "CC_A", "CREDIT_TERM", "odd"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    assert values(df.select(feature_group(F.col("f")).alias("g")), "g") == [
        "social_document",
        "missing_indicators",
        "missing_indicators",
        "credit_card",
        "credit_income_ratios",
        "other",
    ]
    assert group_columns(spark, ["CC_A", "CC_B", "zz"]) == {
        "credit_card": ["CC_A", "CC_B"],
        "other": ["zz"],
    }
    label = spark.createDataFrame([("AMT_CREDIT",), ("SOME_THING",)], "f string")
    assert values(label.select(feature_label(F.col("f")).alias("l")), "l") == [
        "loan amount",
        "some thing",
    ]
