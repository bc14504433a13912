import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import stacking

SCHEMA = "id long, label int, fold int, a double, b double"


def made(n=300, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    a = np.clip(0.4 * y + 0.6 * rng.random(n), 0, 1)
    b = np.clip(0.2 * y + 0.8 * rng.random(n), 0, 1)
    return [(i, int(y[i]), i % 3, float(a[i]), float(b[i])) for i in range(n)]


def newton(x, y, c=1.0):
    """Ridge logistic weights without a penalty on the intercept."""
    z = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(z.shape[1]), np.diag([0.0] + [1 / c] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w = w - np.linalg.solve((z.T * (p * (1 - p))) @ z + penalty, z.T @ (p - y) + penalty @ w)
    return w


def test_equals_newton_on_old_and_new_rows(spark):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA)
    model = stacking.fit_stack(df, ["a", "b"], 3)
    raw = np.array([r[3:] for r in rows])
    mean, scale = raw.mean(0), raw.std(0, ddof=1)
    x, y, fold = (raw - mean) / scale, np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    weights = [newton(x[fold != k], y[fold != k]) for k in range(3)]
    assert np.allclose(model.weights, weights, atol=1e-6)
    out = {r["id"]: r["p"] for r in model.out_of_fold(df).collect()}
    for i in range(len(rows)):
        w = weights[fold[i]]
        assert out[i] == pytest.approx(1 / (1 + np.exp(-(w[0] + x[i] @ w[1:]))), abs=1e-6)
    new = spark.createDataFrame([(0.2, 0.9), (0.7, 0.1)], "a double, b double")
    for r in model.transform(new).collect():
        z = (np.array([r["a"], r["b"]]) - mean) / scale
        want = np.mean([1 / (1 + np.exp(-(w[0] + z @ w[1:]))) for w in weights])
        assert r["p"] == pytest.approx(want, abs=1e-6)


def test_survives_storage_and_streams(spark, tmp_path):
    df = spark.createDataFrame(made(), SCHEMA)
    model = stacking.fit_stack(df, ["a"], 3, extra=["b"])
    model.save(spark, str(tmp_path / "stack"))
    again = stacking.StackModel.load(spark, str(tmp_path / "stack"))
    assert again == model
    source, out, mark = (str(tmp_path / p) for p in ("in", "out", "mark"))
    df.write.parquet(source)
    stream = again.transform(spark.readStream.schema(df.schema).parquet(source))
    query = stream.writeStream.format("parquet").option("checkpointLocation", mark)
    query.trigger(availableNow=True).start(out).awaitTermination()
    assert spark.read.parquet(out).exceptAll(model.transform(df)).count() == 0


def test_missing_inputs_and_odd_tables(spark):
    rows = made(90)
    holes = [(1000 + i, None if i % 2 else 1, None if i % 3 == 0 else 1, None, 0.5) for i in range(6)]
    model = stacking.fit_stack(spark.createDataFrame(rows + holes, SCHEMA), ["a", "b"], 3)
    plain = stacking.fit_stack(spark.createDataFrame(rows, SCHEMA), ["a", "b"], 3)
    assert np.allclose(model.weights, plain.weights) and np.allclose(model.means, plain.means)
    scored = model.transform(spark.createDataFrame(holes, SCHEMA))
    assert scored.where("p IS NULL").count() == 6
    flat = spark.createDataFrame(rows, SCHEMA).withColumn("b", F.lit(0.25))
    assert all(w[2] == 0 for w in stacking.fit_stack(flat, ["a", "b"], 3).weights)
    with pytest.raises(ValueError, match="training part"):
        stacking.fit_stack(spark.createDataFrame([], SCHEMA), ["a", "b"], 3)
    with pytest.raises(ValueError, match="training part"):
        stacking.fit_stack(spark.createDataFrame(rows, SCHEMA).where("label = 1"), ["a", "b"], 3)
