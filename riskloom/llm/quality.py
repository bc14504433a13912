"""Document quality from a linear-chain conditional random field over lines.

Each non-blank line is described by a few measures, cut into bins on the training rows.
The field's potentials use the bins of a line and of both neighbours plus transitions
between good and bad. Labels exist for documents only, so every line of a labelled
document learns with the document's label. Forward-backward marginals give each line a
probability of being good; their mean weighted by line length is the raw score, and a
monotone map fitted on labelled rows the field has not seen turns it into a probability.

Training reads at most ``sample_rows`` labelled rows (chosen by a hash of the id); every
text is scored whole. A null, empty or blank text has no lines and gets the smoothed
share of label 1 among such training rows. Labels that are null or repeated with
different values do not train. Without any labelled row the score is 0.5.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.calibration import monotone
from riskloom.llm.common import texts, tidy

SAMPLE_ROWS = 6_000
BINS = 8
EPOCHS = 60


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Measures of every non-blank line and the lengths of the lines in characters."""
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    if not lines:
        return np.empty((0, 16), np.float32), np.empty(0, np.int64)
    joined = "\n".join(lines)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
    kinds = _KIND[np.minimum(codes, 0x24F)]
    share = {k: np.add.reduceat(kinds == k, starts, dtype=np.int32) / lengths for k in range(7)}
    seen = Counter(lines)
    word_lists = [line.split() for line in lines]
    counts = np.fromiter(map(len, word_lists), np.int64, len(lines))
    distinct = np.fromiter((len(set(w)) for w in word_lists), np.int64, len(lines))
    doubled = np.fromiter((sum(map(eq, w, w[1:])) for w in word_lists), np.int64, len(lines))
    bag = Counter()
    for w in word_lists:
        bag.update(w)
    total = int(counts.sum())
    letters = share[_LOWER] + share[_UPPER]
    many = np.full(len(lines), 1.0)
    out = np.stack(
        [
            np.log1p(lengths),
            np.log1p(counts),
            lengths / np.maximum(counts, 1),
            share[_UPPER] / np.maximum(letters, 1e-9),
            share[_DIGIT],
            share[_PUNCT],
            share[_BANG],
            share[_BAR],
            share[_OTHER],
            distinct / np.maximum(counts, 1),
            doubled / np.maximum(counts, 1),
            np.fromiter((seen[x] > 1 for x in lines), float, len(lines)),
            many * math.log1p(len(lines)),
            many * (len(bag) / max(total, 1)),
            many * math.log1p(total),
            many * (len(seen) / len(lines)),
        ],
        axis=1,
    )
    return out.astype(np.float32), lengths


_LOWER, _UPPER, _DIGIT, _PUNCT, _BANG, _BAR, _OTHER, _SPACE = range(8)


def _kinds() -> np.ndarray:
    table = np.full(0x250, _OTHER, np.uint8)
    for code in range(0x250):
        c = chr(code)
        if c.isspace():
            table[code] = _SPACE
        elif c == "!":
            table[code] = _BANG
        elif c in "|•*#<>{}\\^~":
            table[code] = _BAR
        elif c.isdigit():
            table[code] = _DIGIT
        elif c.isupper():
            table[code] = _UPPER
        elif c.isalpha():
            table[code] = _LOWER
        elif 32 < code < 127:
            table[code] = _PUNCT
    table[0x24F] = _LOWER  # stands for every later character
    return table


_KIND = _kinds()


@dataclass
class Field:
    """``unary[side, measure, bin]`` for (own, previous, next) line; two states, bad and good."""

    cuts: np.ndarray
    unary: np.ndarray
    edge: np.ndarray
    transition: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    empty: float

    def bins(self, features: np.ndarray) -> np.ndarray:
        out = np.empty(features.shape, np.int64)
        for m in range(features.shape[1]):
            out[:, m] = np.searchsorted(self.cuts[m], features[:, m], side="right")
        return out

    def potentials(self, bins: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Log-odds of good per line before the chain is looked at."""
        measures = np.arange(bins.shape[1])
        own, before, after = (self.unary[s][measures, bins].sum(1) for s in range(3))
        total = own.copy()
        total[1:] += before[:-1] * ~first[1:]
        total[:-1] += after[1:] * ~last[:-1]
        return total + first * self.edge[0] + last * self.edge[1]


def marginals(unary: np.ndarray, lengths: np.ndarray, trans: np.ndarray):
    """P(good) per line and expected transitions of chains laid end to end.

    All chains advance together: at step t only those with more than t lines take part.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    size = lengths[order]
    n, longest = len(unary), int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    state = np.stack([np.zeros(n), unary], 1)
    for t in range(longest):
        at = starts[: active[t]] + t
        if t == 0:
            alpha[at] = state[at]
            continue
        a = alpha[at - 1]
        alpha[at] = state[at] + np.logaddexp(a[:, :1] + trans[0], a[:, 1:] + trans[1])
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        b = beta[at + 1] + state[at + 1]
        beta[at] = np.logaddexp(b[:, :1] + trans[:, 0], b[:, 1:] + trans[:, 1])
    both = alpha + beta
    total = np.logaddexp(both[:, 0], both[:, 1])
    good = np.exp(both[:, 1] - total)
    return good, alpha, beta, state, total


def fit(
    features: list[np.ndarray], lengths: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS
) -> Field:
    """The field and its calibration from labelled documents."""
    labels = np.asarray(labels, float)
    full = np.array([len(f) > 0 for f in features], bool)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    empty = (labels[~full].sum() + 2 * rate) / ((~full).sum() + 2)
    measures = 16
    if not full.any():
        zero = np.zeros((3, measures, BINS))
        return Field(np.zeros((measures, 0)), zero, np.zeros(2), np.zeros((2, 2)), np.array([0.0, 1.0]), np.array([rate, rate]), float(empty))
    keep = np.flatnonzero(full)
    stacked = np.concatenate([features[i] for i in keep])
    cuts = [np.unique(np.quantile(stacked[:, m], np.arange(1, BINS) / BINS)) for m in range(measures)]
    pad = np.full((measures, BINS - 1), np.inf)
    for m, c in enumerate(cuts):
        pad[m, : len(c)] = c
    model = Field(pad, np.zeros((3, measures, BINS)), np.zeros(2), np.zeros((2, 2)), None, None, float(empty))
    seen, unseen = keep[np.arange(len(keep)) % 4 != 0], keep[np.arange(len(keep)) % 4 == 0]
    if not len(seen):
        seen = keep
    bins, sizes, first, last, weights = _laid_out(model, features, lengths, seen)
    target = np.repeat(labels[seen], sizes)
    # every document counts the same, however many lines it has
    share = np.repeat(1.0 / sizes, sizes)
    measure_at = np.arange(measures) * BINS
    flat = bins + measure_at
    params = [model.unary, model.edge, model.transition]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    inner = ~first
    before = np.flatnonzero(inner) - 1
    for step in range(1, epochs + 1):
        potential = model.potentials(bins, first, last)
        good, alpha, beta, state, total = marginals(potential, sizes, model.transition)
        error = (target - good) * share
        grad = np.zeros_like(model.unary)
        wide = lambda e, rows: np.bincount(
            flat[rows].ravel(), np.repeat(e, measures), measures * BINS
        ).reshape(measures, BINS)
        every = np.arange(len(bins))
        grad[0] = wide(error, every)
        grad[1] = wide(error[inner], before)
        grad[2] = wide(error[before], before + 1)
        edge = np.array([(error * first).sum(), (error * last).sum()])
        move = np.zeros((2, 2))
        for i in range(2):
            for j in range(2):
                p = np.exp(alpha[before, i] + model.transition[i, j] + state[before + 1, j] + beta[before + 1, j] - total[before])
                real = (target[before] == i) & (target[before + 1] == j)
                move[i, j] = ((real - p) * share[before]).sum()
        grads = [grad / len(seen) - 1e-3 * model.unary, edge / len(seen), move / len(seen) - 1e-2 * model.transition]
        for p, g, (m, v) in zip(params, grads, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    check = unseen if len(unseen) else seen
    raw = _raw_scores(model, *_laid_out(model, features, lengths, check))
    model.knots, model.values = monotone(raw, labels[check], rate)
    return model


def _laid_out(model: Field, features, lengths, chosen):
    sizes = np.array([len(features[i]) for i in chosen], np.int64)
    bins = model.bins(np.concatenate([features[i] for i in chosen]))
    stop = np.cumsum(sizes)
    first, last = np.zeros(len(bins), bool), np.zeros(len(bins), bool)
    first[stop - sizes], last[stop - 1] = True, True
    return bins, sizes, first, last, np.concatenate([lengths[i] for i in chosen])


def _raw_scores(model: Field, bins, sizes, first, last, weights) -> np.ndarray:
    good = marginals(model.potentials(bins, first, last), sizes, model.transition)[0]
    at = np.cumsum(sizes) - sizes
    return np.add.reduceat(good * weights, at) / np.add.reduceat(weights, at)


def score_texts(model: Field, many: list[str]) -> np.ndarray:
    out = np.full(len(many), model.empty)
    described = [line_features(t) for t in many]
    full = [i for i, (f, _) in enumerate(described) if len(f)]
    if full:
        laid = _laid_out(model, [d[0] for d in described], [d[1] for d in described], full)
        out[full] = np.interp(_raw_scores(model, *laid), model.knots, model.values)
    return out


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", usable: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> Field:
    """A field from at most ``sample_rows`` labelled documents for which ``usable`` holds."""
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y"))
        .where("doc_id IS NOT NULL AND y IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("z"))
        .where("y = z")
        .select("doc_id", F.col("y").cast("double").alias("y"))
    )
    if usable is not None:
        known = known.where(usable)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [line_features(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([f.tobytes() for f, _ in pairs], pa.binary()),
                    pa.array([n.tobytes() for _, n in pairs], pa.binary()),
                ],
                ["doc_id", "y", "f", "n"],
            )

    id_type = docs.schema[id_col].dataType
    kind = T.StructType(
        [T.StructField("doc_id", id_type), T.StructField("y", T.DoubleType()), T.StructField("f", T.BinaryType()), T.StructField("n", T.BinaryType())]
    )
    # at most sample_rows ids: the bound of this broadcast
    rows = texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").mapInArrow(tidy(described), kind)
    # an order that no pattern of the ids can follow: every fourth row calibrates
    found = sorted(rows.collect(), key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.n, r.f))
    features = [np.frombuffer(r.f, np.float32).reshape(-1, 16) for r in found]
    lengths = [np.frombuffer(r.n, np.int64) for r in found]
    if not found:
        return fit([np.empty((0, 16), np.float32)] * 0, [], np.empty(0))
    return fit(features, lengths, np.array([r.y for r in found]))


def scored(docs: DataFrame, model: Field, *, text_col: str = "text", name: str = "score") -> DataFrame:
    """The documents with their quality score as column ``name``, in place of one of that name."""

    def score(text):
        import pandas as pd

        return pd.Series(score_texts(model, text.fillna("").tolist()))

    # not deterministic to the planner: run once, however often the score is asked for
    once = F.pandas_udf(score, "double").asNondeterministic()
    return docs.withColumn(name, once(F.col(text_col)))
