"""Gradient-boosted trees with logistic loss on binned features.

``fit`` takes arrays; ``fit_counts`` grows the same trees over a table of any size, of
which the driver sees sums by node, feature and bin only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 16


@dataclass
class Boosted:
    """Full trees of one depth: a feature and a cut per inner node, a value per leaf."""

    cuts: list[np.ndarray]
    features: np.ndarray
    edges: np.ndarray
    leaves: np.ndarray
    start: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.predict_bins(binned(x, self.cuts))

    def predict_bins(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.start)
        rows = np.arange(len(bins))
        depth = int(np.log2(self.leaves.shape[1])) if len(self.leaves) else 0
        for features, edges, leaves in zip(self.features, self.edges, self.leaves):
            node = np.zeros(len(bins), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (bins[rows, features[node]] > edges[node])
            total += leaves[node - (2**depth - 1)]
        return 1 / (1 + np.exp(-total))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.int64)
    for f, c in enumerate(cuts):
        out[:, f] = np.searchsorted(c, x[:, f], side="left")
    return out


def quantile_steps() -> np.ndarray:
    return np.arange(1, BINS) / BINS


def level_sums(bins: np.ndarray, g: np.ndarray, h: np.ndarray, node: np.ndarray, count: int) -> np.ndarray:
    """Sums of g and of h by node, feature and bin."""
    width = bins.shape[1]
    at = ((node[:, None] * width + np.arange(width)) * BINS + bins).ravel()
    return np.stack([np.bincount(at, np.repeat(v, width), count * width * BINS).reshape(count, width, BINS) for v in (g, h)])


def best_cuts(sums: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """The feature and the last bin on the left of the best cut of each node; ``BINS`` for none."""
    gs, hs = sums.cumsum(3)
    gt, ht = gs[:, :, -1:], hs[:, :, -1:]
    gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
    gain = gain.reshape(len(gain), -1)
    best = gain.argmax(1)
    return best // BINS, np.where(gain.max(1) > 1e-6, best % BINS, BINS)


def fit(
    x: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray | None = None,
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.2,
    ridge: float = 1.0,
) -> Boosted:
    """``weight`` says how many rows each row stands for; the cuts see every row once."""
    y = y.astype(float)
    weight = np.ones(len(y)) if weight is None else weight
    width = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], quantile_steps())) if len(x) else np.empty(0) for f in range(width)]
    bins = binned(x, cuts)
    share = ((weight * y).sum() + 1) / (weight.sum() + 2)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(y), start)
    all_features, all_edges, all_leaves = [], [], []
    for _ in range(trees if len(y) else 0):
        p = 1 / (1 + np.exp(-total))
        g, h = weight * (y - p), weight * p * (1 - p)
        inner = 2**depth - 1
        features, edges = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            sums = level_sums(bins, g, h, node - first, count)
            features[first : first + count], edges[first : first + count] = best_cuts(sums, ridge)
            node = 2 * node + 1 + (bins[np.arange(len(y)), features[node]] > edges[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        total += value[leaf]
        all_features.append(features)
        all_edges.append(edges)
        all_leaves.append(value)
    return _boosted(cuts, all_features, all_edges, all_leaves, start)


def _boosted(cuts, features: list, edges: list, leaves: list, start: float) -> Boosted:
    shape = (len(leaves), -1)
    return Boosted(
        cuts,
        np.array(features, np.int64).reshape(shape) if features else np.empty((0, 0), np.int64),
        np.array(edges, np.int64).reshape(shape) if edges else np.empty((0, 0), np.int64),
        np.array(leaves).reshape(shape) if leaves else np.empty((0, 0)),
        start,
    )


def fit_counts(
    table: DataFrame,
    cuts: list[np.ndarray],
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.2,
    ridge: float = 1.0,
) -> Boosted:
    """The trees of ``fit`` over stored rows (bins, n0, n1): a byte for each feature's bin and
    how many rows of either label it stands for.

    Each level of a tree is one job; a task sends one row, its sums by node, feature and bin.
    """
    width = len(cuts)
    n0, n1 = table.agg(F.sum("n0"), F.sum("n1")).first()
    share = (n1 + 1) / (n0 + n1 + 2)
    start = float(np.log(share / (1 - share)))
    all_features, all_edges, all_leaves = [], [], []

    def sums(features: np.ndarray, edges: np.ndarray, level: int) -> np.ndarray:
        model = _boosted(cuts, all_features, all_edges, all_leaves, start)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((2, 2**level, width, BINS))
            for batch in batches:
                raw, zeros, ones = (batch.column(i).to_pylist() for i in range(3))
                bins = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, width).astype(np.int64)
                zeros, ones = np.array(zeros, float), np.array(ones, float)
                p = model.predict_bins(bins)
                node = np.zeros(len(bins), np.int64)
                for _ in range(level):
                    node = 2 * node + 1 + (bins[np.arange(len(bins)), features[node]] > edges[node])
                g, h = ones * (1 - p) - zeros * p, (zeros + ones) * p * (1 - p)
                out += level_sums(bins, g, h, node - (2**level - 1), 2**level)
            yield pa.record_batch([pa.array([out.tobytes()], pa.binary())], ["sums"])

        rows = table.select("bins", "n0", "n1").mapInArrow(work, "sums binary").collect()
        return sum(np.frombuffer(r.sums).reshape(2, 2**level, width, BINS) for r in rows)

    for _ in range(trees):
        inner = 2**depth - 1
        features, edges = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            found = sums(features, edges, level)
            features[first : first + count], edges[first : first + count] = best_cuts(found, ridge)
        # what lies on either side of the last cuts is known from their sums
        own = found[:, np.arange(count), features[first:]]
        left = (own * (np.arange(BINS) <= edges[first:, None])).sum(2)
        g, h = np.stack([left, own.sum(2) - left], 2).reshape(2, -1)
        all_features.append(features)
        all_edges.append(edges)
        all_leaves.append(rate * g / (h + ridge))
    return _boosted(cuts, all_features, all_edges, all_leaves, start)
