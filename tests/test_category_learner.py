import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.operators import category_learner as cl
from riskloom.operators import metrics, training

SCHEMA = "id long, y int, fold int, a string, b string, x double"


def made(n=240):
    rows = []
    for i in range(n):
        a = None if i % 13 == 0 else "hot" if i % 3 else f"c{i % 7}"
        y = None if i % 29 == 0 else int((i * 7919 % 101) < (70 if i % 3 else 20))
        rows.append((i, y, None if i % 41 == 40 else i * 31 // 7 % 3, a, f"={i % 5}" if i % 5 else "", i / 7))
    return rows


def brute(rows, column, folds, weight=1.0):
    """Code of every row and model from plain loops over the rows before it."""
    def place(r):
        return hashlib.md5(f"42|{r[0]}".encode()).hexdigest()[:15], r[0]

    def code(r, k):
        train = [t for t in rows if t[1] is not None and (t[2] is None or t[2] != k)]
        if r[2] != k:
            train = [t for t in train if place(t) < place(r)]
        same = [t[1] for t in train if t[column] == r[column]]
        prior = (sum(t[1] for t in train) + 0.5) / (len(train) + 1)
        return (sum(same) + weight * prior) / (len(same) + weight)

    return {r[0]: [code(r, k) for k in range(folds)] for r in rows}


@pytest.mark.parametrize("rows_per_bucket", [1_000, 20])
def test_codes_equal_brute_force(spark, rows_per_bucket):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = cl.ordered_codes(df, ["a", "b"], "id", "y", 3, rows_per_bucket=rows_per_bucket).rows.collect()
    want_a, want_b = brute(rows, 3, 3), brute(rows, 4, 3)
    assert len(got) == len(rows)
    for r in got:
        assert r["a_ots"] == pytest.approx(want_a[r["id"]], abs=1e-12)
        assert r["b_ots"] == pytest.approx(want_b[r["id"]], abs=1e-12)


def test_no_label_moves_its_own_code(spark):
    rows = made(60)
    first = {r["id"]: r["a_ots"] for r in cl.ordered_codes(
        spark.createDataFrame(rows, SCHEMA), ["a"], "id", "y", 3).rows.collect()}
    for at in (1, 17, 44):
        flipped = [(r[0], 1 - r[1], *r[2:]) if r[0] == at else r for r in rows]
        again = cl.ordered_codes(spark.createDataFrame(flipped, SCHEMA), ["a"], "id", "y", 3).rows
        assert again.where(F.col("id") == at).first()["a_ots"] == first[at]


def test_new_rows_and_empty_input(spark):
    rows = made()
    codes = cl.ordered_codes(spark.createDataFrame(rows, SCHEMA), ["a"], "id", "y", 3)
    new = spark.createDataFrame([(1, "hot"), (2, None), (3, "never seen")], "id long, a string")
    got = {r["id"]: r["a_ots"] for r in codes.transform(new).collect()}
    for k in range(3):
        train = [t for t in rows if t[1] is not None and t[2] != k]
        prior = (sum(t[1] for t in train) + 0.5) / (len(train) + 1)
        for i, a in ((1, "hot"), (2, None), (3, "never seen")):
            same = [t[1] for t in train if t[3] == a]
            assert got[i][k] == pytest.approx((sum(same) + prior) / (len(same) + 1))
    nothing = cl.ordered_codes(spark.createDataFrame([], SCHEMA), ["a"], "id", "y", 3)
    assert nothing.rows.count() == 0
    assert nothing.transform(new).first()["a_ots"] == [0.5] * 3


def test_learner_reads_the_categories(spark):
    df = spark.createDataFrame([r for r in made(600)], SCHEMA)
    build = training.forest(trees=10, max_depth=4, min_rows=5)
    cv = cl.run_category_cv(df, ["a", "b"], ["x"], "id", "y", build, 3)
    usable = df.where("y IS NOT NULL AND fold IS NOT NULL")
    assert cv.result.oof.count() == usable.count()
    # per-fold AUC from the stored scores, pair by pair
    stored = cv.result.oof.collect()
    for r in cv.result.fold_metrics().collect():
        ones = [o["p"] for o in stored if o["fold"] == r["fold"] and o["label"] == 1]
        zeros = [o["p"] for o in stored if o["fold"] == r["fold"] and o["label"] == 0]
        wins = sum((p > q) + 0.5 * (p == q) for p in ones for q in zeros)
        assert r["auc"] == pytest.approx(wins / len(ones) / len(zeros))
        assert r["auc"] > 0.65
    again = cv.predict(df)
    assert again.count() == 600 and again.where("p IS NULL OR p < 0 OR p > 1").count() == 0
    area = metrics.auc(again.join(usable, "id"), label="y", score="p").first()["auc"]
    assert area > 0.65
