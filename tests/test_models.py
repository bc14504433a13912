import itertools
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import calibration, ensemble, explain, folds, scoring, training

PARAMS = training.BoostParams(max_iter=4, step_size=0.4, max_depth=3, min_rows=5, max_bins=16)
FEATURES = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.1 * rng.normal(size=600) > 0).astype(int)
    rows = [
        (i, int(t), *(None if (i + j) % 23 == 0 else float(v) for j, v in enumerate(r)), "uvw"[i % 3])
        for i, (r, t) in enumerate(zip(x, y, strict=True))
    ]
    return spark.createDataFrame(
        rows, "SK_ID_CURR long, TARGET int, x0 double, x1 double, x2 double, kind string"
    )


@pytest.fixture(scope="module")
def trained(planted):
    config = scoring.TrainConfig(
        folds=2, n_features=None, learner_a=PARAMS, learner_b=PARAMS, blend_steps=10
    )
    return scoring.train(planted, config)


def test_training_finds_the_planted_signal(trained):
    values = {r["metric"]: r["value"] for r in trained.metrics.collect()}
    assert values["auc_blend_oof"] > 0.9 and values["auc_calibrated"] > 0.9
    assert 0 <= values["weight_a"] <= 1
    assert trained.oof.count() == 600


def test_each_fold_selects_its_own_features(spark, planted):
    config = scoring.TrainConfig(
        folds=2, n_features=1, method="mutual_info", learner_a=PARAMS, learner_b=PARAMS, blend_steps=4
    )
    doubled = planted.withColumn("x3", F.when(F.col("SK_ID_CURR") % 2 == 0, F.col("x1")).otherwise(0.1))
    bundle = scoring.train(doubled, config).bundle
    assert len(bundle.chosen_a) == 2 and set(sum(bundle.chosen_a, [])) == set(bundle.features)
    out = bundle.score(doubled, reasons=True)
    assert out.count() == 600 and out.where(F.col("predicted_pd").isNull()).count() == 0


def test_bundle_survives_storage(spark, planted, trained, tmp_path):
    path = str(tmp_path / "bundle")
    trained.bundle.save(path)
    again = scoring.Bundle.load(spark, path)
    one = trained.bundle.score(planted).orderBy("SK_ID_CURR").collect()
    two = again.score(planted).orderBy("SK_ID_CURR").collect()
    assert one == two
    assert all(r["decision"] in (0, 1) for r in one)


def test_reasons_and_threshold(planted, trained):
    out = trained.bundle.score(planted.limit(20), threshold=2.0, reasons=True).collect()
    assert all(r["decision"] == 0 for r in out)
    for r in out:
        sizes = [abs(p["contribution"]) for p in r["top_reasons"]]
        assert sizes == sorted(sizes, reverse=True) and len(sizes) <= 5


def test_column_order_guard(planted, trained):
    matrix = trained.bundle.matrix(planted)
    swapped = matrix.select(matrix.columns[0], *reversed(matrix.columns[1:]))
    with pytest.raises(ValueError, match="feature 0 is .* the model was trained on"):
        trained.bundle.explain(swapped)


@pytest.mark.parametrize("method", ["shapley", "path"])
def test_contributions_sum_to_the_margin(spark, planted, method):
    folded = folds.stratified_folds(planted, "SK_ID_CURR", "TARGET", 2)
    prepared = training.prepare(folded, FEATURES, "SK_ID_CURR", "TARGET")
    model = training.run_cv(prepared, FEATURES, "SK_ID_CURR", training.boosted(PARAMS), 2).models[0]
    parts = explain.tree_contributions(planted, "SK_ID_CURR", FEATURES, [model], method=method).collect()
    own = {
        r["SK_ID_CURR"]: r["p"]
        for r in model.transform(prepared).select("SK_ID_CURR", training.probability().alias("p")).collect()
    }
    assert len(parts) == 600
    for r in parts:
        raw = r["base_value"] + sum(r["contributions"])
        assert 1 / (1 + math.exp(-raw)) == pytest.approx(own[r["SK_ID_CURR"]], abs=1e-9)


def random_tree(rng, n_features, depth, rows=64.0):
    left, right, feature, threshold, value, cover = [], [], [], [], [], []

    def grow(level, n):
        at = len(left)
        for column, v in zip((left, right, feature, threshold, value, cover), (-1, -1, -1, 0.0, rng.normal(), n)):
            column.append(v)
        if level and n >= 2 and rng.random() < 0.85:
            share = 1 + rng.integers(int(n) - 1)
            feature[at], threshold[at] = rng.integers(n_features), rng.normal() / 2
            left[at] = grow(level - 1, float(share))
            right[at] = grow(level - 1, n - share)
        return at

    grow(depth, rows)
    return explain.TreeNodes(*map(np.array, (left, right, feature, threshold, value)), 0.7, np.array(cover))


def expected_value(tree, row, known, node=0):
    """The tree's value when only the features in ``known`` are known."""
    if tree.left[node] < 0:
        return tree.weight * tree.value[node]
    sides = tree.left[node], tree.right[node]
    if tree.feature[node] in known:
        side = sides[0] if row[tree.feature[node]] <= tree.threshold[node] else sides[1]
        return expected_value(tree, row, known, side)
    shares = [tree.cover[s] / tree.cover[node] for s in sides]
    return sum(share * expected_value(tree, row, known, s) for share, s in zip(shares, sides))


@pytest.mark.parametrize("seed", range(12))
def test_shapley_values_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    n = 5
    trees = [random_tree(rng, n, depth) for depth in (0, 1, 3, 6)]
    x = rng.normal(size=(7, n)) / 2
    base, got = explain.shapley_values(x, [explain.LeafTable(t) for t in trees])
    for row, mine in zip(x, got):
        for j in range(n):
            others = [i for i in range(n) if i != j]
            want = 0.0
            for size in range(n):
                weight = math.factorial(size) * math.factorial(n - 1 - size) / math.factorial(n)
                for known in itertools.combinations(others, size):
                    gain = (expected_value(t, row, {*known, j}) - expected_value(t, row, set(known)) for t in trees)
                    want += weight * sum(gain)
            assert mine[j] == pytest.approx(want, abs=1e-10)
        assert base + mine.sum() == pytest.approx(sum(expected_value(t, row, set(range(n))) for t in trees))


def test_shapley_rows_are_cut_into_parts(monkeypatch):
    rng = np.random.default_rng(1)
    tree, x = random_tree(rng, 4, 5), rng.normal(size=(33, 4))
    whole = explain.shapley_values(x, [explain.LeafTable(tree)])[1]
    monkeypatch.setattr(explain, "CELLS", 1)
    table = explain.LeafTable(tree)
    assert table.rows == 1
    assert np.allclose(explain.shapley_values(x, [table])[1], whole)


def test_a_tree_without_rows_per_node_has_no_shapley_values():
    tree = random_tree(np.random.default_rng(0), 3, 3)
    with pytest.raises(ValueError, match="no training rows"):
        explain.LeafTable(replace(tree, cover=np.full(len(tree.left), -1.0)))


def test_seeds_side_by_side_equal_one_after_another(spark, planted):
    rows = folds.stratified_folds(planted, "SK_ID_CURR", "TARGET", 3)
    rows = training.prepare(rows, FEATURES, "SK_ID_CURR", "TARGET")
    chosen = [FEATURES, FEATURES[:2], FEATURES[::2]]

    def build(seed):
        return training.forest(trees=5, max_depth=3, min_rows=5, seed=seed)

    side = training.run_seeds(rows, FEATURES, "SK_ID_CURR", build, 3, [3, 1, 2], chosen, parallel=3)
    plain = [training.run_cv(rows, FEATURES, "SK_ID_CURR", build(s), 3, chosen) for s in (3, 1, 2)]
    parts = [{r.SK_ID_CURR: r.p for r in result.oof.collect()} for result in plain]
    for result, part in zip(side.results, parts, strict=True):
        assert {r.SK_ID_CURR: r.p for r in result.oof.collect()} == part
    want = {k: (parts[0][k] + parts[1][k] + parts[2][k]) / 3.0 for k in parts[0]}
    assert {r.SK_ID_CURR: r.p for r in side.oof().collect()} == want
    log = side.log().orderBy("step").collect()
    assert [r.seed for r in log] == [3, 1, 2] and len({r.oof_auc for r in log}) > 1
    assert [r.oof_auc for r in log] == [result.scores()[0] for result in plain]
    # new rows: every model of every seed, one after another
    each = []
    for result in plain:
        for k, model in enumerate(result.models):
            out = model.transform(training.sliced(rows, FEATURES, chosen[k]))
            each.append({r.SK_ID_CURR: r.p for r in out.select("SK_ID_CURR", training.probability().alias("p")).collect()})
    for r in side.score(rows).collect():
        assert r.p == pytest.approx(sum(e[r.SK_ID_CURR] for e in each) / 9, abs=1e-12)
    folded = training.run_cv(rows, FEATURES, "SK_ID_CURR", build(3), 3, chosen, parallel=3)
    assert {r.SK_ID_CURR: r.p for r in folded.oof.collect()} == parts[0]
    with pytest.raises(ValueError):
        training.run_seeds(rows, FEATURES, "SK_ID_CURR", build, 3, [1, 1])


def test_seeds_fit_folds_side_by_side_where_partitions_are_few(spark, planted, monkeypatch):
    rows = folds.stratified_folds(planted, "SK_ID_CURR", "TARGET", 3)
    rows = training.prepare(rows, FEATURES, "SK_ID_CURR", "TARGET").coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert training.folds_at_once(rows, 5, 1) == min(5, 2 * cores)
    assert training.folds_at_once(rows.repartition(2 * cores), 5, 3) == 1
    asked, plain = [], training.concurrently

    def noted(session, tasks, parallel):
        asked.append((len(tasks), parallel))
        return plain(session, tasks, parallel)

    def build(seed):
        return training.forest(trees=2, max_depth=2, min_rows=5, seed=seed)

    monkeypatch.setattr(training, "concurrently", noted)
    training.run_seeds(rows, FEATURES, "SK_ID_CURR", build, 3, [1, 2], parallel=2)
    assert sorted(asked) == [(2, 2), (3, min(3, cores)), (3, min(3, cores))]
    asked.clear()
    training.run_seeds(rows, FEATURES, "SK_ID_CURR", build, 3, [1, 2], parallel=1)
    assert sorted(asked) == [(2, 1), (3, 1), (3, 1)]


def test_forest_keeps_the_nodes_of_rows_and_grows_the_same_trees(spark, planted):
    rows = folds.stratified_folds(planted, "SK_ID_CURR", "TARGET", 3)
    rows = training.prepare(rows, FEATURES, "SK_ID_CURR", "TARGET")
    build = training.forest(trees=5, max_depth=4, min_rows=5)
    assert build().getCacheNodeIds()
    kept, walked = build().fit(rows), build().setCacheNodeIds(False).fit(rows)
    assert [t.toDebugString.split("\n")[1:] for t in kept.trees] == [t.toDebugString.split("\n")[1:] for t in walked.trees]
    assert kept.totalNumNodes > 5


def test_concurrent_tasks_keep_order_and_raise(spark):
    from riskloom.plans.concurrent import concurrently

    tasks = [lambda n=n: spark.range(n).count() for n in (5, 3, 9, 0, 2)]
    assert concurrently(spark, tasks, 3) == concurrently(spark, tasks, 1) == [5, 3, 9, 0, 2]
    with pytest.raises(ZeroDivisionError):
        concurrently(spark, [*tasks, lambda: 1 // 0], 2)
    assert concurrently(spark, [], 4) == []


def test_blend_ends_and_search(spark):
    rows = [(i, float(i % 2), i % 3, (i % 2) * 0.5 + i / 1000, (i * 7 % 11) / 11) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, label double, inner_fold int, a double, b double")
    ends = df.select(
        "a", "b", ensemble.blend(F.col("a"), F.col("b"), 1.0).alias("one"),
        ensemble.blend(F.col("a"), F.col("b"), 0.0).alias("zero"),
    ).collect()
    assert all(r["one"] == r["a"] and r["zero"] == r["b"] for r in ends)
    by_fold = ensemble.blend_weight_by_fold(df, "a", "b", steps=10)
    assert by_fold.count() == 3 and by_fold.agg(F.min("held_auc")).first()[0] == 1.0
    best = ensemble.simplex_search(df, ["a", "b"], ensemble.simplex_candidates(2, 8)).first()
    assert best["auc"] == 1.0 and sum(best["weights"]) == pytest.approx(1.0)


def test_blend_on_cells_equals_the_search_over_rows(spark):
    rng = np.random.default_rng(4)
    rows = [
        (int(i % 4), float(rng.integers(0, 2)), round(float(rng.random()), 2), round(float(rng.random()), 2))
        for i in range(400)
    ]
    rows = [(f, y, a * 0.6 + y * 0.3, b * 0.8 + y * 0.2) for f, y, a, b in rows]
    odd = [(1, 1.0, None, 0.5), (2, 0.0, 0.5, None), (3, None, 0.5, 0.5)]
    df = spark.createDataFrame(rows + odd, "inner_fold int, label double, a double, b double")
    cells = ensemble.score_cells(df, ["a", "b"], fold="inner_fold", digits=2)
    known = df.dropna()
    assert cells.agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == known.count()
    assert ensemble.score_cells(known.union(known), ["a", "b"], fold="inner_fold", digits=2).count() == cells.count()
    on_grid = [(F.floor(F.col(c) * 100 + 0.5) / 100.0).alias(c) for c in "ab"]
    plain = ensemble.blend_weight_by_fold(known.select("inner_fold", "label", *on_grid), "a", "b", steps=20)
    fast = ensemble.blend_weight_on_cells(cells, "a", "b", steps=20)
    want = {r.inner_fold: (r.weight, r.train_auc, r.held_auc) for r in plain.collect()}
    got = {r.inner_fold: (r.weight, r.train_auc, r.held_auc) for r in fast.collect()}
    assert len(got) == 4 and got == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}
    # a fold without one of the classes has no area of its own
    one = known.where("inner_fold <> 2 OR label = 1")
    lone = ensemble.blend_weight_on_cells(ensemble.score_cells(one, ["a", "b"], fold="inner_fold"), "a", "b", steps=4)
    assert {r.inner_fold for r in lone.collect() if r.held_auc is None} == {2}
    nothing = ensemble.score_cells(df.limit(0), ["a", "b"], fold="inner_fold")
    assert ensemble.blend_weight_on_cells(nothing, "a", "b", steps=4).count() == 0


def test_calibration_on_held_out_half(spark):
    rng = np.random.default_rng(0)
    p = rng.random(2000)
    y = (rng.random(2000) < p**2).astype(float)
    df = spark.createDataFrame(
        [(i, float(t), float(v)) for i, (t, v) in enumerate(zip(y, p, strict=True))],
        "id long, label double, p double",
    )
    result = calibration.calibrate_with_split(df, "id")
    assert result.evaluated.count() in (999, 1000)
    raw = ((p - y) ** 2).mean()
    assert min(result.brier.values()) < raw and result.best in calibration.METHODS
    iso = result.calibrators["isotonic"].transform(df, "p", "q").orderBy("p").collect()
    q = [r["q"] for r in iso]
    assert all(b >= a - 1e-12 for a, b in zip(q, q[1:])) and min(q) >= 0 and max(q) <= 1


def test_isotonic_knots(spark):
    df = spark.createDataFrame(
        [(0.1, 0.0), (0.2, 1.0), (0.3, 0.0), (0.4, 1.0)], "p double, label double"
    )
    cal = calibration.fit_isotonic(df)
    at = spark.createDataFrame([(0.0,), (0.15,), (0.25,), (0.35,), (0.9,)], "p double")
    out = [r["q"] for r in cal.transform(at, "p", "q").collect()]
    assert out == pytest.approx([0.0, 0.25, 0.5, 0.75, 1.0])


def test_stacking_scores_every_row(spark):
    rows = [(i, float(i % 2), i % 3, 0.3 + 0.4 * (i % 2) + (i % 5) / 50, 0.5) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, label double, fold int, a double, b double")
    out = ensemble.stack(df, ["a", "b"], "id", 3)
    assert out.count() == 90 and out.select("id").distinct().count() == 90


def test_log_delta(spark):
    log = spark.createDataFrame([(0, 0.7), (1, 0.75), (2, 0.74)], "step int, oof_auc double")
    out = [r["delta"] for r in training.log_with_delta(log).orderBy("step").collect()]
    assert out == pytest.approx([0.0, 0.05, -0.01])


def test_linear_reasons_ties_by_name(spark):
    df = spark.createDataFrame([(1, 3.0, 1.0, 0.1)], "id long, b double, a double, c double")
    means = {"b": 2.5, "a": 1.5, "c": 0.0}
    pairs = explain.linear_contributions(df, "id", {"b": 1.0, "a": 1.0, "c": 1.0}, means)
    out = explain.reason_rows(pairs, "id", 2).orderBy("rank").collect()
    assert [(r["feature"], r["rank"], r["contribution"]) for r in out] == [("a", 1, -0.5), ("b", 2, 0.5)]
    text = explain.reason_text(pairs, "id", 1).first()["reasons"]
    assert text == "1. A - Decreases risk"


def test_stream_scoring_equals_batch(spark, planted, trained, tmp_path):
    from riskloom.streaming import scoring as streams

    source = str(tmp_path / "in")
    planted.repartition(3).write.parquet(source)
    stream = streams.parquet_stream(spark, source, planted.schema, files_per_batch=1)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    streams.score_stream(stream, trained.bundle.score, out, mark).awaitTermination()
    batch = trained.bundle.score(planted)
    streamed = spark.read.parquet(out).select(batch.columns)
    assert streamed.count() == 600 and streamed.exceptAll(batch).count() == 0
