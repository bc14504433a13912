import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift, fairness, metrics
from riskloom.plans.ordering import percentiles, running_totals


def scored(spark, n=400, seed=3, ties=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = rng.random()
        p = round(p, 2) if ties else p
        y = int(rng.random() < 0.2 + 0.5 * p)
        rows.append((i, "a" if i % 3 else "b", float(y), p))
    return spark.createDataFrame(rows, "id long, g string, label double, score double"), rows


def brute_auc(rows):
    pos = [p for _, _, y, p in rows if y == 1]
    neg = [p for _, _, y, p in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def brute_ks(rows):
    pos = np.array([p for _, _, y, p in rows if y == 1])
    neg = np.array([p for _, _, y, p in rows if y == 0])
    grid = sorted({p for _, _, _, p in rows})
    return max(abs((pos <= t).mean() - (neg <= t).mean()) for t in grid)


@pytest.mark.parametrize("ties", [True, False])
def test_report_against_brute_force(spark, ties):
    df, rows = scored(spark, ties=ties)
    out = metrics.report(df).first()
    assert out["auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert out["ks"] == pytest.approx(brute_ks(rows), abs=1e-12)
    y, p = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    assert out["brier"] == pytest.approx(((p - y) ** 2).mean())
    assert out["tp"] == int(((p >= 0.5) & (y == 1)).sum())
    assert out["expected_loss"] == pytest.approx((out["fp"] + 5 * out["fn"]) / len(rows))


def test_bucketed_ranking_equals_plain(spark, monkeypatch):
    from riskloom.plans import ordering

    df, rows = scored(spark, ties=False)
    plain = metrics.report(df).first()
    by_group = {r["g"]: r["auc"] for r in metrics.auc(df, keys=["g"]).collect()}
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 20)
    bucketed = metrics.report(df).first()
    for name in plain.asDict():
        assert bucketed[name] == pytest.approx(plain[name], abs=1e-12)
    again = {r["g"]: r["auc"] for r in metrics.auc(df, keys=["g"]).collect()}
    assert again == pytest.approx(by_group)


def test_hot_value_in_bucketed_ranking(spark, tiny_buckets):
    rows = [(i, "a", float(i % 2), 0.5) for i in range(200)]
    rows += [(1000 + i, "a", float(i % 3 == 0), i / 400) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, label double, score double")
    assert metrics.auc(df).first()["auc"] == pytest.approx(brute_auc(rows), abs=1e-12)


def test_grid_ranking(spark):
    df, rows = scored(spark)
    assert metrics.auc(df, digits=6).first()["auc"] == pytest.approx(brute_auc(rows), abs=1e-12)


def test_single_class_and_perfect_order(spark):
    one = spark.createDataFrame([(0.0, 0.1), (0.0, 0.2)], "label double, score double")
    row = metrics.report(one).first()
    assert row["auc"] is None and row["ks"] == 0.0
    good = spark.createDataFrame(
        [(0.0, 0.1), (0.0, 0.2), (1.0, 0.8), (1.0, 0.9)], "label double, score double"
    )
    assert metrics.auc(good).first()["auc"] == 1.0


def test_expected_loss_case(spark):
    df = spark.createDataFrame([(0.0, 0.9), (1.0, 0.1)], "label double, score double")
    assert metrics.expected_loss(df).first()["expected_loss"] == 3.0


def test_running_totals_with_null_keys(spark, tiny_buckets):
    rows = [(None if i % 2 else "k", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = running_totals(df, ["k"], "v", {"n": F.lit(1)}).collect()
    assert len(out) == 100
    assert all(r["total_n"] == 50 and r["before_n"] == int(r["v"]) // 2 for r in out)


@pytest.mark.parametrize("bucketed", [False, True])
def test_percentiles(spark, bucketed, monkeypatch):
    from riskloom.plans import ordering

    if bucketed:
        monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 10)
    rng = np.random.default_rng(0)
    data = np.concatenate([rng.normal(size=150), np.full(70, 0.25)])
    df = spark.createDataFrame([("x", float(v)) for v in data] + [("x", None)], "k string, v double")
    asked = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.99, "e": 1.0}
    row = percentiles(df, ["k"], "v", asked).first()
    for name, q in asked.items():
        assert row[name] == pytest.approx(np.percentile(data, q * 100), abs=1e-12)


# -- drift ----------------------------------------------------------------------------


def numpy_psi(ref, cur, n_bins=10, eps=1e-6):
    ref, cur = (np.where(np.isnan(x), -999.0, x) for x in (ref, cur))
    distinct = np.unique(ref)
    if len(distinct) < n_bins:
        edges = np.linspace(distinct.min(), distinct.max() + 1e-10, len(distinct) + 1)
    else:
        edges = np.percentile(ref, np.linspace(0, 100, n_bins + 1))
    r = np.histogram(ref, bins=edges)[0] + eps
    c = np.histogram(cur, bins=edges)[0] + eps
    r, c = r / r.sum(), c / c.sum()
    return float(((c - r) * np.log(c / r)).sum())


def frame(spark, **columns):
    names = list(columns)
    rows = [
        tuple(None if np.isnan(v) else float(v) for v in row)
        for row in zip(*columns.values(), strict=True)
    ]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


@pytest.mark.parametrize("bucketed", [False, True])
def test_psi_against_numpy(spark, bucketed, monkeypatch):
    from riskloom.plans import ordering

    if bucketed:
        monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 25)
    rng = np.random.default_rng(1)
    ref = {"a": rng.normal(size=300), "b": rng.integers(0, 4, 300).astype(float)}
    cur = {"a": rng.normal(0.4, 1.2, size=200), "b": rng.integers(1, 5, 200).astype(float)}
    ref["a"][:30] = np.nan
    out = {
        r["feature"]: r["psi"]
        for r in drift.psi(frame(spark, **ref), frame(spark, **cur), ["a", "b"]).collect()
    }
    assert out["a"] == pytest.approx(numpy_psi(ref["a"], cur["a"]), rel=1e-9)
    assert out["b"] == pytest.approx(numpy_psi(ref["b"], cur["b"]), rel=1e-9)


def test_drift_of_itself_is_zero(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, x=rng.normal(size=100), y=rng.integers(0, 3, 100).astype(float))
    for row in drift.drift_report(df, df).collect():
        assert row["psi"] == 0 and row["ks"] == 0 and not row["drifted"]


def test_null_rates(spark):
    nan = float("nan")
    ref, cur = frame(spark, x=[1.0, 2.0, 3.0, nan]), frame(spark, x=[1.0, nan, nan, nan])
    assert drift.null_rates(ref, cur, ["x"]).first()["null_shift"] == 0.5
    gone = frame(spark, x=[nan] * 4)
    row = drift.drift_report(ref, gone).first()
    assert (row["ref_null_rate"], row["cur_null_rate"], row["null_shift"]) == (0.25, 1.0, 0.75)
    none = drift.drift_report(gone, gone).first()
    assert none["psi"] == 0 and none["null_shift"] == 0


def test_no_common_columns(spark):
    assert drift.drift_report(frame(spark, a=[1.0]), frame(spark, b=[1.0])).count() == 0


def test_ks_does_not_depend_on_row_order(spark):
    a = frame(spark, x=[3.0, 1.0, 2.0])
    assert drift.ks_drift(a, frame(spark, x=[2.0, 3.0, 1.0]), ["x"]).first()["ks"] == 0


def test_current_outside_reference(spark):
    out = drift.drift_report(frame(spark, x=list(map(float, range(20)))), frame(spark, x=[-5.0, 3.0, 99.0])).first()
    assert out["n_outside"] == 2


# -- fairness -------------------------------------------------------------------------


def test_fairness_report(spark):
    preds = spark.createDataFrame(
        [(1, 0.2, 0), (2, 0.4, 0), (3, 0.9, 1), (4, 0.4, 1), (5, 0.6, 0)],
        "SK_ID_CURR long, predicted_pd double, TARGET int",
    )
    people = spark.createDataFrame(
        [(1, "M"), (2, "M"), (3, "M"), (4, "F"), (5, "F")], "SK_ID_CURR long, CODE_GENDER string"
    )
    out = {r["grp"]: r for r in fairness.fairness_report(preds, people).collect()}
    assert out["M"]["count"] == 3 and out["M"]["mean_pred"] == pytest.approx(0.5)
    assert out["F"]["count"] == 2 and out["F"]["disparity"] == pytest.approx(0)
    assert out["F"]["mean_target"] == 0.5
    few = people.where("SK_ID_CURR < 5")
    assert sum(r["count"] for r in fairness.fairness_report(preds, few).collect()) == 4
    audit = fairness.row_count_mismatch(preds, people.union(people)).first()
    assert audit["n_joined"] == 10 and audit["row_count_mismatch"]
