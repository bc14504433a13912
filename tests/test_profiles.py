"""Frozen profiles: sketches, bounds of KS, one scan of the batch only."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift, profiles
from riskloom.plans.lineage import stored

TYPES = "a double, b double, few int, same double, gaps double, empty double"


def rows(seed, n, shift=0.0):
    rng = np.random.default_rng(seed)
    return [
        (
            float(rng.normal() + shift),
            float(rng.exponential() * (1 + shift)),
            int(rng.integers(4)),
            7.0,
            None if rng.random() < 0.2 + shift / 4 else float(rng.integers(50)),
            None,
        )
        for _ in range(n)
    ]


@pytest.fixture(scope="module")
def pair(spark):
    return spark.createDataFrame(rows(1, 3000), TYPES), spark.createDataFrame(rows(2, 2000, 0.3), TYPES)


def column(df, name):
    return np.array([r[name] for r in df.collect() if r[name] is not None and not math.isnan(r[name])], float)


def true_ks(x, y):
    at = np.concatenate([x, y])
    return max(abs((x <= v).mean() - (y <= v).mean()) for v in at)


@pytest.mark.parametrize("exact", [True, False])
def test_counts_and_bounds_equal_brute_force(spark, pair, exact):
    ref, cur = pair
    names = ["a", "b", "few", "same", "gaps", "empty"]
    profile = profiles.freeze(ref, names, exact=exact)
    assert sorted(r.feature for r in profile.collect()) == ["a", "b", "few", "gaps", "same"]
    for r in profile.collect():
        x, cuts = column(ref, r.feature), np.array(r.cuts)
        inside = [int(((x >= a) & (x < b)).sum()) for a, b in zip(cuts[:-1], cuts[1:])] or [0]
        inside[-1] += int((x == cuts[-1]).sum())
        assert r.counts == [int((x < cuts[0]).sum()), *inside, int((x > cuts[-1]).sum())]
        assert r.n_null == 3000 - len(x) and set(r.edges) <= set(r.cuts)
    for r in profiles.compared(profile, cur).collect():
        x, y = column(ref, r.feature), column(cur, r.feature)
        assert r.ks - 1e-12 <= true_ks(x, y) <= r.ks_upper + 1e-12
        assert (r.ref_total, r.cur_total) == (len(x), len(y))
        assert r.n_outside == int(((y < x.min()) | (y > x.max())).sum())
        assert r.cur_null_rate == pytest.approx(1 - len(y) / 2000)


def test_report_on_sketches_is_near_the_exact_one(pair):
    exact = {r.feature: r for r in drift.drift_report(*pair).collect()}
    near = {r.feature: r for r in profiles.drift_report(*pair, k=1000).collect()}
    assert set(near) == set(exact) and len(near) == 6
    for f, r in near.items():
        assert abs(r.psi - exact[f].psi) <= max(0.01, exact[f].psi * 0.1), f
        assert r.ks - 1e-6 <= exact[f].ks <= r.ks_upper + 1e-6
        assert (r.ref_null_rate, r.cur_null_rate, r.null_shift) == (
            exact[f].ref_null_rate, exact[f].cur_null_rate, exact[f].null_shift
        )


def test_sketches_of_parts_merge(spark, pair):
    ref, cur = pair
    parts = profiles.sketches(ref, ["a"]).unionByName(profiles.sketches(cur, ["a"]))
    merged = parts.groupBy("feature").agg(F.kll_merge_agg_double("sketch").alias("s"))
    median = merged.select(F.kll_sketch_get_quantile_double("s", F.lit(0.5))).first()[0]
    both = np.concatenate([column(ref, "a"), column(cur, "a")])
    assert abs((both <= median).mean() - 0.5) < 0.01


def test_monitor_reads_no_reference_and_shuffles_no_cells(spark, pair, tmp_path):
    ref, cur = pair
    ref.write.parquet(str(tmp_path / "reference"))
    cur.write.parquet(str(tmp_path / "batch"))
    profile = stored(profiles.freeze(spark.read.parquet(str(tmp_path / "reference")), ["a", "few", "gaps"]), "profile")
    batch = spark.read.parquet(str(tmp_path / "batch"))
    out = profiles.check_batch_against(profile, batch, ["few", "gaps", "gone"], "a")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "reference" not in plan and plan.count("FileScan") <= 2
    got = {r.feature: r for r in out.collect()}
    want = {r.feature: r for r in drift.check_batch(ref, cur, ["few", "gaps", "gone"], "a").collect()}
    for f, r in got.items():
        assert (r.psi, r.status, r.alert, r.n_samples) == (want[f].psi, want[f].status, want[f].alert, want[f].n_samples)
    assert got["gone"].status == "no values" and got["gone"].alert == "ALERT"


def test_nan_empty_batch_and_a_constant(spark):
    ref = spark.createDataFrame([(1.0, float("nan")), (1.0, 2.0), (None, 3.0)], "same double, b double")
    profile = profiles.freeze(ref, ["same", "b"])
    by = {r.feature: r for r in profile.collect()}
    assert by["same"].counts == [0, 2, 0] and by["b"].n_null == 1
    empty = profiles.compared(profile, ref.limit(0)).collect()
    assert all(r.ks is None and r.cur_total == 0 for r in empty)
    other = spark.createDataFrame([(0.0, 2.0), (5.0, 2.0)], "same double, b double")
    got = {r.feature: r for r in profiles.compared(profile, other).collect()}
    assert got["same"].n_outside == 2 and got["same"].ks == 0.5
    with pytest.raises(ValueError, match="must divide"):
        profiles.freeze(ref, ["b"], n_bins=7)
