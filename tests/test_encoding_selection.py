import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import encoders, folds, profiling, selection


def test_ordinal_unseen_and_missing(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "cat string")
    model = encoders.OrdinalEncoder().fit(fit)
    out = model.transform(spark.createDataFrame([("a",), ("c",), ("d",), (None,)], "cat string"))
    assert [r["cat"] for r in out.collect()] == [0, 2, -1, -2]


def test_ranks_over_many_partitions(spark):
    values = [("x", f"v{i:04d}") for i in range(2000)] + [("y", f"w{i:03d}") for i in range(50)]
    df = spark.createDataFrame(values, "feature string, category string").repartition(8)
    ranks = encoders.ranks_in_order(df, "feature", "category").collect()
    got = {(r["feature"], r["category"]): r["code"] for r in ranks}
    assert len(got) == 2050
    assert all(got["x", f"v{i:04d}"] == i for i in range(2000))
    assert all(got["y", f"w{i:03d}"] == i for i in range(50))


def test_bayes_target_mean(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), ("b", 0)], "cat string, y int")
    model = encoders.TargetEncoder(m=1000.0).fit(df, "y")
    out = [r["cat"] for r in model.transform(df).collect()]
    assert out == pytest.approx([502 / 1002] * 2 + [500 / 1002] * 2)
    unseen = spark.createDataFrame([("z", 0), (None, 0)], "cat string, y int")
    assert [r["cat"] for r in model.transform(unseen).collect()] == [0.5, 0.5]
    zero = encoders.TargetEncoder(handle_unknown="zero").fit(df, "y")
    assert [r["cat"] for r in zero.transform(unseen).collect()] == [0.0, 0.0]


def test_fold_encoding_ignores_own_fold(spark):
    rows = [(i, "ab"[i % 2], i % 3, int(i % 5 == 0)) for i in range(60)]
    schema = "id long, cat string, fold int, y int"
    flipped = [(i, c, f, 1 - y if f == 1 else y) for i, c, f, y in rows]
    encoder = encoders.TargetEncoder(["cat"])
    one, two = (
        {r["id"]: r["cat_te"] for r in encoder.fold_safe(spark.createDataFrame(d, schema), "y").collect()}
        for d in (rows, flipped)
    )
    own = [i for i, _, f, _ in rows if f == 1]
    assert [one[i] for i in own] == [two[i] for i in own]
    assert any(one[i] != two[i] for i, _, f, _ in rows if f != 1)


def test_fold_encoding_equals_refit(spark):
    rows = [(i, ["a", "b", None][i % 3], i % 4, int(i % 7 < 2)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, cat string, fold int, y int")
    encoder = encoders.TargetEncoder(["cat"])
    got = {r["id"]: r["cat_te"] for r in encoder.fold_safe(df, "y").collect()}
    for k in range(4):
        model = encoder.fit(df.where(F.col("fold") != k), "y")
        for r in model.transform(df.where(F.col("fold") == k)).collect():
            assert got[r["id"]] == pytest.approx(r["cat"])


def test_stratified_folds_are_exact_and_stable(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1003)], "id long, y int")
    out = folds.stratified_folds(df, "id", "y", 5)
    sizes = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    assert sorted(sizes[1, k] for k in range(5)) == [20, 20, 20, 20, 21]
    assert max(sizes[0, k] for k in range(5)) - min(sizes[0, k] for k in range(5)) <= 1
    again = folds.stratified_folds(df.repartition(7), "id", "y", 5)
    assert out.exceptAll(again).count() == 0


def test_split_is_disjoint_and_falls_back(spark):
    df = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)], "id long, y int")
    out = folds.stratified_split(df, "id", "y")
    counts = {(r["y"], r["is_eval"]): r["count"] for r in out.groupBy("y", "is_eval").count().collect()}
    assert counts == {(0, True): 37, (0, False): 38, (1, True): 12, (1, False): 13}
    lonely = spark.createDataFrame([(i, int(i == 0)) for i in range(50)], "id long, y int")
    assert folds.stratified_split(lonely, "id", "y").count() == 50


def test_constant_and_duplicate(spark):
    rows = [(i, 7.0, float(i), float(i), None if i % 2 else 1.0, -float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, flat double, a double, b double, half double, c double")
    constant, duplicate = selection.constant_and_duplicate(df, ["flat", "a", "b", "half", "c"], "id")
    assert constant == ["flat", "half"] and duplicate == ["b"]


def test_wanted_count():
    assert selection.wanted_count(100, 0.3, None, 10) == 30
    assert selection.wanted_count(100, 5, None, 10) == 10
    assert selection.wanted_count(8, 5, None, 10) == 8
    assert selection.wanted_count(100, None, 20, 10) == 20
    assert selection.wanted_count(100, None, None, 10) == 100


def test_mutual_information_finds_the_signal(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    y = (x[:, 1] > 0).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, n0 double, signal double, n1 double, y int")
    out = selection.top_by_mutual_information(df, ["n0", "signal", "n1"], "y").collect()
    assert out[0]["feature"] == "signal" and out[0]["mutual_info"] > 0.5
    chosen = selection.select_features(df, ["n0", "signal", "n1"], "y", "id", "mutual_info", 1, 1)
    assert chosen == ["signal"]


def test_selection_fallbacks(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0, i % 2) for i in range(10)], "id long, a double, b double, y int")
    assert selection.select_features(df, ["a", "b"], "y", "id") == ["a", "b"]


def test_correlation_paths_agree(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = rng.normal(size=(200, 4)) + 1000
    data[:, 1] = data[:, 0] * 2
    rows = [tuple(None if rng.random() < 0.1 else float(v) for v in r) + (3.0,) for r in data]
    names = ["a", "b", "c", "d", "same"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    direct = {(r["a"], r["b"]): r["corr"] for r in profiling.correlations(df, names).collect()}
    monkeypatch.setattr(profiling, "DIRECT_PAIRS", 0)
    wide = {(r["a"], r["b"]): r["corr"] for r in profiling.correlations(df, names).collect()}
    expected = df.toPandas().corr()
    for (a, b), value in direct.items():
        if "same" in (a, b):
            assert value is None and wide[a, b] is None
        else:
            assert value == pytest.approx(expected.loc[a, b], abs=1e-9)
            assert wide[a, b] == pytest.approx(value, abs=1e-9)


def test_histogram_keeps_the_top_edge(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    rows = profiling.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [2, 2, 2, 2, 3]
    assert sum(r["density"] for r in rows) * 2.0 == pytest.approx(1.0)
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert profiling.histogram(flat, "v", 5).first()["n"] == 2
