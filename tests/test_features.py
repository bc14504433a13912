import pytest
from pyspark.sql import functions as F

from riskloom.operators import application, assemble, children
from riskloom.plans.joins import checked_left_join, count_without_children, lookup_join
from riskloom.sources import sinks, tables

BUREAU = tables.TABLES["bureau"].ddl
ROWS = [
    (1, 10, "Active", 0, -100, 50.0, 1000.0, 500.0, 0.0, 0),
    (1, 11, "Closed", 0, -500, None, 2000.0, None, 0.0, 1),
    (2, 12, "Closed", 5, -30, 10.0, 0.0, 100.0, 7.0, 0),
    (3, 13, "Active", 0, -10, 10.0, None, None, None, 2),
    (None, 14, "Active", 0, -10, 10.0, 5.0, 5.0, 0.0, 0),
]


def by_key(df, key="SK_ID_CURR"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_bureau_profile_nulls(spark):
    out = by_key(children.bureau_profile(spark.createDataFrame(ROWS, BUREAU)))
    assert sorted(out) == [1, 2, 3]
    assert (out[1]["BUREAU_LOAN_COUNT"], out[1]["BUREAU_ACTIVE_COUNT"]) == (2, 1)
    assert out[1]["BUREAU_DEBT_TOTAL"] == 500.0 and out[1]["BUREAU_DEBT_MEAN"] == 500.0
    assert out[2]["BUREAU_OVERDUE_COUNT"] == 1
    # no active loan: every active measure is missing
    assert out[2]["BUREAU_ACTIVE_DEBT_TOTAL"] is None
    assert out[2]["BUREAU_ACTIVE_CREDIT_MEAN"] is None
    # total credit of zero guards the ratio
    assert out[2]["BUREAU_DEBT_CREDIT_RATIO"] == 0.0
    # active loan with unknown amounts: total is zero, means are missing
    assert out[3]["BUREAU_ACTIVE_DEBT_TOTAL"] == 0.0
    assert out[3]["BUREAU_ACTIVE_DEBT_MEAN"] is None
    assert out[3]["BUREAU_CREDIT_SUM_TOTAL"] == 0.0 and out[3]["BUREAU_CREDIT_SUM_MEAN"] is None


def test_profiles_hold_the_published_measures(spark):
    sizes = {
        name: len(p.measures) + len(p.ratios)
        for name, p in {
            "bureau": children.BUREAU,
            "loan": children.BUREAU_BALANCE_LOAN,
            "balance": children.BUREAU_BALANCE,
            "previous": children.PREVIOUS,
            "installments": children.INSTALLMENTS,
            "pos": children.POS_CASH,
            "card": children.CREDIT_CARD,
        }.items()
    }
    assert sizes == {
        "bureau": 27,
        "loan": 7,
        "balance": 8,
        "previous": 20,
        "installments": 16,
        "pos": 14,
        "card": 18,
    }


def test_bureau_balance_drops_orphans(spark):
    months = spark.createDataFrame(
        [(1, -1, "C"), (1, -2, "2"), (2, -1, "1"), (9, -1, "5")], tables.TABLES["bureau_balance"].ddl
    )
    bridge = spark.createDataFrame([(7, 1), (7, 2)], "SK_ID_CURR long, SK_ID_BUREAU long")
    out = by_key(children.bureau_balance_profile(months, bridge))
    assert list(out) == [7]
    assert out[7]["BB_NUM_BUREAU_CREDITS"] == 2
    assert out[7]["BB_STATUS_MEAN_OF_MEANS"] == 1.0
    assert out[7]["BB_TOTAL_BAD_MONTHS"] == 1
    assert out[7]["BB_DPD_RATE_MEAN"] == 0.75


def test_unpaid_instalment(spark):
    rows = [(1, 1, -100.0, None, 50.0, None), (1, 2, -60.0, -20.0, 50.0, 50.0)]
    df = spark.createDataFrame(rows, tables.TABLES["installments_payments"].ddl)
    out = by_key(children.installments_profile(df))[1]
    assert out["INS_LATE_COUNT"] == 1 and out["INS_VERY_LATE_COUNT"] == 1
    assert out["INS_DAYS_LATE_MEAN"] == 40.0
    assert out["INS_UNDERPAID_COUNT"] == 1 and out["INS_PAYMENT_RATIO_MIN"] == 0.0


def test_previous_without_approved_rows(spark):
    ddl = tables.TABLES["previous_application"].ddl
    row = (1, 5, "Refused", 10.0, 20.0, 1.0, None, None, 12.0, -30) + (None,) * 5
    out = by_key(children.previous_profile(spark.createDataFrame([row], ddl)))[1]
    assert out["PREV_APPROVED_COUNT"] is None and out["PREV_APPROVAL_RATE"] == 0.0
    assert out["PREV_REFUSED_COUNT"] == 1 and out["PREV_REFUSAL_RATE"] == 1.0


def test_card_without_drawings(spark):
    ddl = tables.TABLES["credit_card_balance"].ddl
    rows = [(1, -1, 0, 100.0, 50.0, 10.0, 5.0, 0.0, 0.0, 0.0, 0.0)]
    out = by_key(children.credit_card_profile(spark.createDataFrame(rows, ddl)))[1]
    assert out["CC_CASH_DRAW_RATIO_MEAN"] is None
    assert out["CC_UTILIZATION_MAX"] == 1.0 and out["CC_MAXED_COUNT"] == 1


def test_application_features_with_missing_columns(spark):
    df = spark.createDataFrame([(1, 100.0, 50.0)], "SK_ID_CURR long, AMT_CREDIT double, AMT_INCOME_TOTAL double")
    row = application.application_features(df).first()
    assert row["CREDIT_INCOME_RATIO"] == pytest.approx(100 / 51)
    assert row["AGE_YEARS"] is None and row["EXT_SOURCE_MEAN"] is None
    assert row["DOCUMENT_COUNT"] == 0 and row["DOCUMENT_MISSING"] == 1


def test_application_blocks_are_one_projection(spark):
    df = spark.createDataFrame([], tables.TABLES["application_train"].ddl)
    plan = application.application_features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1


def test_align_and_split(spark):
    train = spark.createDataFrame([(1, 0, 2.0, "a")], "SK_ID_CURR long, TARGET int, x double, s string")
    test = spark.createDataFrame([(9, 3.0)], "SK_ID_CURR long, x double")
    x, y, x_test = assemble.split_target(train, test)
    assert x.columns == ["SK_ID_CURR", "x", "s"] and y.columns == ["SK_ID_CURR", "TARGET"]
    assert x_test.schema == x.schema and x_test.first()["s"] is None


def test_checked_join(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    out = {r["k"]: r["v"] for r in checked_left_join(left, right, "k").collect()}
    assert out == {1: "a", 2: "b", 3: None}
    twice = right.union(spark.createDataFrame([(1, "c")], "k long, v string"))
    with pytest.raises(ValueError, match="3 -> 4"):
        checked_left_join(left, twice, "k")
    unrelated = right.union(spark.createDataFrame([(8, "x"), (8, "y")], "k long, v string"))
    assert checked_left_join(left, unrelated, "k").count() == 3


def test_lookup_join_with_hot_key_and_nulls(spark):
    rows = [("hot", i) for i in range(300)] + [("cold", -1), (None, -2)]
    df = spark.createDataFrame(rows, "k string, i int")
    small = spark.createDataFrame([("hot", 1.0), ("other", 2.0)], "k string, v double")
    got = [tuple(r) for r in lookup_join(df, small, ["k"]).collect()]
    assert sorted(got, key=str) == sorted([(k, i, 1.0 if k == "hot" else None) for k, i in rows], key=str)


def test_parents_without_children(spark):
    p = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    c = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert tuple(count_without_children(p, c, "k").first()) == (3, 2)


def test_partition_count_does_not_matter(spark):
    df = spark.createDataFrame([(i % 7, i, float(i)) for i in range(500)], "SK_ID_CURR long, SK_ID_BUREAU long, AMT_CREDIT_SUM double")
    profile = children.Profile(measures=[children.Measure("m", "mean", "AMT_CREDIT_SUM"), children.Measure("n", "count", "SK_ID_BUREAU")])
    one = by_key(children.profile_children(df.repartition(1), profile))
    many = by_key(children.profile_children(df.repartition(8), profile))
    assert one == many


def test_narrowing_bounds(spark):
    df = spark.createDataFrame(
        [(1, 127, 100000, True, 1.5), (3, 0, 300000, False, None)],
        "a long, b long, c long, d boolean, e double",
    )
    assert sinks.narrowed_types(df) == {
        "a": "tinyint",
        "b": "smallint",
        "c": "int",
        "d": "tinyint",
        "e": "float",
    }
    assert [tuple(r) for r in sinks.narrow(df).collect()] == [(1, 127, 100000, 1, 1.5), (3, 0, 300000, 0, None)]


def test_csv_scan_matches_header_by_name(spark, tmp_path):
    path = tmp_path / "bureau.csv"
    path.write_text(
        "EXTRA,SK_ID_BUREAU,SK_ID_CURR,CREDIT_ACTIVE,DAYS_CREDIT_ENDDATE,CREDIT_DAY_OVERDUE\n"
        "7,10,1,Active,365243,0\n8,11,2,,12.0,3\n"
    )
    df = tables.load_table(spark, "bureau", str(tmp_path))
    rows = df.orderBy("SK_ID_CURR").collect()
    assert [r["SK_ID_BUREAU"] for r in rows] == [10, 11]
    assert [r["DAYS_CREDIT_ENDDATE"] for r in rows] == [None, 12.0]
    assert rows[1]["CREDIT_ACTIVE"] is None and rows[0]["EXTRA"] == 7


def test_csv_scan_types_and_misfits(spark, tmp_path):
    path = tmp_path / "bureau.csv"
    lines = [f"{i},1.0,{i},NA,True,x{i}" for i in range(400)] + ["12.75,3.0,NA,,False,NA"]
    path.write_text("a,CREDIT_DAY_OVERDUE,b,empty,flag,name\n" + "\n".join(lines))
    df = tables.scan(spark, str(path), ddl=BUREAU)
    assert df.dtypes == [
        ("a", "double"), ("CREDIT_DAY_OVERDUE", "int"), ("b", "bigint"), ("empty", "double"),
        ("flag", "boolean"), ("name", "string"),
    ]
    assert df.where("a = 12.75 AND CREDIT_DAY_OVERDUE = 3 AND b IS NULL AND name IS NULL").count() == 1
    assert df.count() == 401 and df.where("a IS NULL").count() == 0
    path.write_text("CREDIT_DAY_OVERDUE\n1\n2.5\n")
    with pytest.raises(Exception, match="CREDIT_DAY_OVERDUE does not hold int: 2.5"):
        tables.scan(spark, str(path), ddl=BUREAU).collect()


def test_null_group_sum_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "SK_ID_CURR long, v double")
    profile = children.Profile(measures=[children.Measure("s", "sum", "v"), children.Measure("m", "mean", "v")])
    row = children.profile_children(df, profile).first()
    assert row["s"] == 0.0 and row["m"] is None


def test_full_matrix_keeps_every_applicant(spark):
    from riskloom.catalog.features import clean_application, credit_tables

    sf = "/root/testdata/sf0.001"
    app = clean_application(spark, sf)
    full = assemble.build_features(app, credit_tables(spark, sf))
    assert full.count() == app.count() == full.select("SK_ID_CURR").distinct().count()
    assert full.where(F.col("CC_MONTHS_COUNT").isNull()).count() > 0
