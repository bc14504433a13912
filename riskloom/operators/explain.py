"""Per-row contributions of features to a score, and the reasons built from them.

Linear scores are explained by columns (exact). Tree ensembles are explained by exact
Shapley values of the path-dependent game: a known feature sends a row down its own
side, an unknown one down both sides in the shares of the training rows. The base value
is the mean over the training rows and base + contributions equals the model's log-odds.
Plain path attribution (each split's change of the node value is credited to the split
feature) stays as the cheaper ``method="path"``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import zip_longest

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import sigmoid
from riskloom.functions.naming import capitalize_first, feature_label
from riskloom.operators.training import filled_sql
from riskloom.plans.lineage import scratch_path

TOP_REASONS = 5
# Spark's boosted trees turn a margin m into 1 / (1 + exp(-2 m)).
MARGIN_TO_LOG_ODDS = 2.0


def check_feature_order(columns: Sequence[str], expected: Sequence[str]) -> None:
    """Raise at the first place where the columns leave the order the model was trained on."""
    for place, (mine, known) in enumerate(zip_longest(columns, expected)):
        if mine != known:
            raise ValueError(f"feature {place} is {mine!r}, the model was trained on {known!r}")


# -- linear scores ---------------------------------------------------------------------


def linear_contributions(
    df: DataFrame, key: str, coefficients: dict[str, float], means: dict[str, float]
) -> DataFrame:
    """(key, pairs) with contribution = coefficient * (value - mean) per feature.

    The pairs stay one array per row, so reasons and scores need no shuffle.
    """
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                (F.col(c).cast("double") * w - F.lit(float(means[c] * w))).alias("contribution"),
            )
            for c, w in coefficients.items()
        ]
    )
    return df.select(key, pairs.alias("pairs"))


def contribution_rows(df: DataFrame, key: str) -> DataFrame:
    """(key, feature, contribution): the pairs as a tall table."""
    return df.select(key, F.inline("pairs"))


# -- tree ensembles --------------------------------------------------------------------


@dataclass(frozen=True)
class TreeNodes:
    """Node arrays of one tree; a leaf has ``left`` = -1."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    weight: float
    cover: np.ndarray | None = None  # training rows in each node


def _placed(tree: TreeNodes, positions: Sequence[int]) -> TreeNodes:
    """The tree with feature numbers of the full feature list (leaves keep -1)."""
    at = np.asarray(positions, dtype=np.int64)
    moved = np.where(tree.feature >= 0, at[np.maximum(tree.feature, 0)], -1)
    return replace(tree, feature=moved)


def tree_nodes(spark: SparkSession, model: Model) -> list[TreeNodes]:
    """Node arrays of a fitted boosted-tree model, read from its saved node table.

    The table is as large as the model, not the data.
    """
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    split = "nodeData.split"
    rows = (
        spark.read.parquet(f"{path}/data")
        .select(
            "treeID",
            F.col("nodeData.id").alias("id"),
            F.col("nodeData.prediction").alias("value"),
            F.col("nodeData.rawCount").alias("cover"),
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.col(f"{split}.featureIndex").alias("feature"),
            F.get(f"{split}.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        )
        .toPandas()
        .sort_values(["treeID", "id"])
    )
    out = []
    for tree, nodes in rows.groupby("treeID"):
        out.append(
            TreeNodes(
                nodes["left"].to_numpy(dtype=np.int64),
                nodes["right"].to_numpy(dtype=np.int64),
                nodes["feature"].to_numpy(dtype=np.int64),
                nodes["threshold"].to_numpy(dtype=float),
                nodes["value"].to_numpy(dtype=float),
                float(model.treeWeights[int(tree)]),
                nodes["cover"].to_numpy(dtype=float),
            )
        )
    return out


CELLS = 1 << 21


class LeafTable:
    """The leaves of a tree as arrays for exact Shapley values.

    A leaf has a slot for each distinct feature on its path. ``zero`` is the share of training
    rows that the feature's splits let through, ``wrong`` numbers the sides of splits that
    keep a row from it. With one-fraction o and zero-fraction z the
    Shapley value of a slot is value * (o - z) * integral over t in [0, 1] of the product
    of z + t (o - z) over the leaf's other slots; a Gauss rule of half as many nodes as
    slots gives that polynomial's integral exactly.
    """

    def __init__(self, tree: TreeNodes):
        if tree.cover is None or (tree.cover <= 0).any():
            raise ValueError("the tree has no training rows per node, so no Shapley values")
        self.inner = np.flatnonzero(tree.left >= 0)
        place = {int(node): i for i, node in enumerate(self.inner)}
        leaves: list[tuple[float, dict[int, tuple[float, list[tuple[int, bool]]]]]] = []
        todo: list[tuple[int, dict]] = [(0, {})]
        while todo:
            node, path = todo.pop()
            if tree.left[node] < 0:
                leaves.append((tree.weight * tree.value[node], path))
                continue
            feature = int(tree.feature[node])
            zero, splits = path.get(feature, (1.0, []))
            for child, side in ((tree.left[node], True), (tree.right[node], False)):
                share = zero * tree.cover[child] / tree.cover[node]
                todo.append((int(child), {**path, feature: (share, [*splits, (place[node], side)])}))
        self.slots = max(1, max(len(path) for _, path in leaves))
        self.features = tree.feature[self.inner]
        self.thresholds = tree.threshold[self.inner]
        self.value = np.array([v for v, _ in leaves])
        self.zero = np.ones((len(leaves), self.slots))
        self.used = np.unique(self.features) if len(self.inner) else np.empty(0, np.int64)
        cells = len(leaves) * self.slots
        splits_of: list[list[tuple[int, bool]]] = [[] for _ in range(cells)]
        feature_of = np.full(cells, -1)
        for i, (_, path) in enumerate(leaves):
            for j, (feature, (share, splits)) in enumerate(path.items()):
                self.zero[i, j] = share
                splits_of[i * self.slots + j] = splits
                feature_of[i * self.slots + j] = feature
        # columns of [went left, went right, never]: a leaf on the left is missed by going right
        n = len(self.inner)
        self.wrong = np.full((max(1, max(map(len, splits_of))), cells), 2 * n)
        for cell, splits in enumerate(splits_of):
            for k, (at, leaf_is_left) in enumerate(splits):
                self.wrong[k, cell] = at + n if leaf_is_left else at
        self.by_feature = np.argsort(feature_of, kind="stable")[int((feature_of < 0).sum()) :]
        self.starts = np.searchsorted(feature_of[self.by_feature], self.used)
        self.base = float(self.value @ self.zero.prod(axis=1))
        nodes, weights = np.polynomial.legendre.leggauss((self.slots + 1) // 2)
        self.rule = list(zip((nodes + 1) / 2, weights / 2))
        self.rows = max(1, CELLS // cells)

    def add_to(self, out: np.ndarray, x: np.ndarray) -> None:
        """Add the tree's Shapley values of the rows ``x`` to ``out``."""
        if not len(self.inner):
            return
        for low in range(0, len(x), self.rows):
            some = slice(low, low + self.rows)
            left = x[some][:, self.features] <= self.thresholds
            sides = np.concatenate([left, ~left, np.zeros((len(left), 1), bool)], axis=1)
            missed = sides[:, self.wrong[0]]
            for more in self.wrong[1:]:
                missed |= sides[:, more]
            gain = (~missed).reshape(len(left), *self.zero.shape) - self.zero
            total = np.zeros_like(gain)
            for t, weight in self.rule:
                factor = self.zero + t * gain
                before, after = np.ones_like(factor), np.ones_like(factor)
                np.cumprod(factor[..., :-1], axis=-1, out=before[..., 1:])
                after[..., :-1] = np.cumprod(factor[..., :0:-1], axis=-1)[..., ::-1]
                total += weight * before * after
            shares = (gain * total * self.value[:, None]).reshape(len(left), -1)
            out[some][:, self.used] += np.add.reduceat(shares[:, self.by_feature], self.starts, axis=1)


def shapley_values(x: np.ndarray, leaves: Sequence[LeafTable]) -> tuple[float, np.ndarray]:
    """Base value and (rows, features) exact Shapley values of the margin."""
    out = np.zeros(x.shape)
    for table in leaves:
        table.add_to(out, x)
    return sum(table.base for table in leaves), out


def attribute_paths(x: np.ndarray, trees: Sequence[TreeNodes]) -> tuple[float, np.ndarray]:
    """Base value and (rows, features) contributions to the margin."""
    rows = np.arange(len(x))
    out = np.zeros(x.shape)
    base = 0.0
    for t in trees:
        base += t.weight * t.value[0]
        at = np.zeros(len(x), dtype=np.int64)
        live = rows[t.left[at] >= 0]
        while len(live):
            here = at[live]
            used = t.feature[here]
            goes_left = x[live, used] <= t.threshold[here]
            there = np.where(goes_left, t.left[here], t.right[here])
            out[live, used] += t.weight * (t.value[there] - t.value[here])
            at[live] = there
            live = live[t.left[there] >= 0]
    return base, out


def tree_contributions(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    models: Sequence[Model],
    chosen: Sequence[Sequence[str]] | None = None,
    carry: Sequence[str] = (),
    method: str = "shapley",
) -> DataFrame:
    """(key, carried columns, base_value, contributions) in log-odds, averaged over the
    models.

    ``contributions`` follows the order of ``features``; ``chosen`` names the inputs of
    each model when a model was fitted on some of them only. ``carry`` passes further
    columns through, so that they need no join. ``method`` is ``shapley`` or ``path``.
    """
    place = {c: i for i, c in enumerate(features)}
    picks = chosen if chosen is not None else [list(features)] * len(models)
    trees_of = [
        [_placed(t, [place[c] for c in pick]) for t in tree_nodes(df.sparkSession, m)]
        for m, pick in zip(models, picks, strict=True)
    ]
    return contributions_of_trees(df, key, features, trees_of, carry, method, MARGIN_TO_LOG_ODDS)


def contributions_of_trees(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    ensembles: Sequence[Sequence[TreeNodes]],
    carry: Sequence[str] = (),
    method: str = "shapley",
    scale: float = 1.0,
) -> DataFrame:
    """:func:`tree_contributions` for node arrays, averaged over the ensembles.

    What is broadcast is as large as the trees; rows are explained in Arrow batches.
    """
    check = [f for f in features if f not in df.columns]
    if check:
        raise ValueError(f"Columns missing for the explanation: {check}")
    if method not in ("shapley", "path"):
        raise ValueError(f"unknown method {method!r}")
    names = list(features)
    nodes = df.sparkSession.sparkContext.broadcast([list(trees) for trees in ensembles])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        explained = attribute_paths
        packed = nodes.value
        if method == "shapley":
            packed = [[LeafTable(t) for t in trees] for trees in nodes.value]
            explained = shapley_values
        for batch in batches:
            x = batch[names].to_numpy(dtype=float)
            base, total = 0.0, np.zeros(x.shape)
            for trees in packed:
                b, c = explained(x, trees)
                base, total = base + b, total + c
            out = batch[kept].copy()
            out["base_value"] = base * scale / len(packed)
            out["contributions"] = list(total * (scale / len(packed)))
            yield out

    kept = [key, *carry]
    filled = df.selectExpr(*[f"`{c}`" for c in kept], *[filled_sql(c) for c in names])
    kinds = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return filled.mapInPandas(
        explain, f"{schema}, base_value double, contributions array<double>"
    )


def explained_scores(contributions: DataFrame, key: str, calibrator=None) -> DataFrame:
    """raw_score = base + sum of contributions, linked to a probability, then calibrated."""
    summed = F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    raw = contributions.withColumn("raw_score", F.col("base_value") + summed)
    linked = raw.withColumn("_linked", sigmoid(F.col("raw_score")))
    out = (
        calibrator.transform(linked, "_linked", "pd")
        if calibrator is not None
        else linked.withColumn("pd", F.col("_linked"))
    )
    return out.select(
        key,
        F.round("pd", 6).alias("pd"),
        F.round("raw_score", 6).alias("raw_score"),
        F.round("base_value", 6).alias("base_value"),
        "contributions",
    )


def named_contributions(contributions: Column, features: Sequence[str]) -> Column:
    names = F.array(*[F.lit(f) for f in features])
    return F.zip_with(
        names,
        contributions,
        lambda f, c: F.struct(f.alias("feature"), c.alias("contribution")),
    )


def top_reasons(pairs: Column, n: int = TOP_REASONS, digits: int | None = None) -> Column:
    """The ``n`` largest contributions by size, ties by name; no shuffle is needed."""
    keyed = F.transform(
        pairs,
        lambda p: F.struct(
            (-F.abs(p["contribution"])).alias("k"), p["feature"], p["contribution"]
        ),
    )

    def shown(p: Column) -> Column:
        value = p["contribution"] if digits is None else F.round(p["contribution"], digits)
        return F.struct(p["feature"].alias("feature"), value.alias("contribution"))

    return F.transform(F.slice(F.array_sort(keyed), 1, n), shown)


def reason_rows(df: DataFrame, key: str, n: int = TOP_REASONS) -> DataFrame:
    """(key, rank, feature, contribution) of the top reasons of every row."""
    top = F.posexplode(top_reasons(F.col("pairs"), n)).alias("_i", "_r")
    return df.select(key, top).select(
        key, (F.col("_i") + 1).alias("rank"), "_r.feature", "_r.contribution"
    )


def global_importance(df: DataFrame, share: float = 1.0, seed: int = 42) -> DataFrame:
    """Features by mean absolute contribution over all rows or a seeded sample."""
    rows = df if share >= 1.0 else df.sample(share, seed=seed)
    return (
        rows.groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )


def explanation_rows(reasons: DataFrame, key: str) -> DataFrame:
    """Reason table with wording, direction and size, one row per rank."""
    return reasons.select(
        key,
        "rank",
        feature_label(F.col("feature")).alias("factor"),
        F.when(F.col("contribution") > 0, "increases risk")
        .otherwise("decreases risk")
        .alias("direction"),
        F.round(F.abs("contribution"), 5).alias("impact"),
    )


def reason_text(df: DataFrame, key: str, n: int = TOP_REASONS) -> DataFrame:
    """(key, reasons): numbered reasons in one string, for a letter or a reply."""

    def line(reason: Column, i: Column) -> Column:
        words = capitalize_first(feature_label(reason["feature"]))
        way = F.when(reason["contribution"] > 0, "Increases risk").otherwise("Decreases risk")
        return F.concat((i + 1).cast("string"), F.lit(". "), words, F.lit(" - "), way)

    lines = F.transform(top_reasons(F.col("pairs"), n), line)
    return df.select(key, F.array_join(lines, "; ").alias("reasons"))
