"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are words and their beginnings of four to six characters. The vocabulary holds the
terms whose presence goes with the label: among their rows the odds of label 1 differ from
the overall odds by ``least_odds`` or more, ``prior_rows`` rows at the overall share
included, a floor that does not depend on the number of rows; of more than ``vocabulary``
such terms those with the largest chi-square. Document
frequencies are counted over all documents. The labelled examples form an inverted index
in blocks: each term has its postings by block and the largest weight in every block. A
query visits blocks by decreasing upper bound and stops when no block can still enter its
``k`` nearest, so the neighbours are exact. Votes are weighted by inverse distance and
mapped to probabilities by a monotone fit on leave-one-out votes of at most
``calibration_rows`` examples, evenly spread.

Learning reads at most ``sample_rows`` labelled rows (chosen by a hash of the id); that
bounds the broadcast index. Near copies among them with the same label, confirmed on their
full sets of 3-word shingles (``near_percent`` hundredths in common) and linked in
components, count once: the smallest id stays. Rows without words all stay. A text without
any vocabulary term, such as a null or empty one, gets the smoothed share of label 1 among such examples; without labels the score is
0.5 for all. Null labels and ids with contradicting labels do not train. Equal cosines
prefer the smaller id.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.calibration import monotone
from riskloom.llm.common import stored, texts
from riskloom.llm.minhash import one_of_each

SAMPLE_ROWS = 20_000
VOCABULARY = 4_000
NEIGHBOURS = 15
NEAR_PERCENT = 80
LEAST_ODDS = 2.0
PRIOR_ROWS = 10.0
CALIBRATION_ROWS = 3_000
BLOCK = 64
WORD = re.compile(r"\w+")
HELD = 200_000
HELD_VECTORS = 50_000


def terms_of(word: str) -> list[str]:
    """The word itself (marked) and its beginnings."""
    return [word + "$", *(word[:n] for n in (4, 5, 6) if len(word) >= n)]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[int]] = {}

    def flush() -> pa.RecordBatch:
        out = pa.record_batch(
            [
                pa.array(held.keys(), pa.string()),
                pa.array([v[0] for v in held.values()], pa.int64()),
                pa.array([v[1] for v in held.values()], pa.int64()),
            ],
            ["term", "n", "n1"],
        )
        held.clear()
        return out

    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for term in {t for w in set(WORD.findall(text.lower())) for t in terms_of(w)}:
                entry = held.setdefault(term, [0, 0])
                entry[0] += 1
                entry[1] += y
            if len(held) >= HELD:
                yield flush()
    if held:
        yield flush()


class Vocabulary:
    """Term numbers, with the numbers of every word met remembered up to a bound."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.met: set[str] = set()
        self.known: dict[str, tuple[int, ...]] = {}
        self.useful: set[str] = set()

    def __reduce__(self):
        return Vocabulary, (list(self.number),)

    def counts(self, text: str) -> Counter:
        words = Counter(WORD.findall(text.lower()))
        distinct = set(words)
        if len(self.met) >= HELD:
            self.met.clear()
            self.known.clear()
            self.useful.clear()
        for word in distinct.difference(self.met):
            numbers = tuple(self.number[t] for t in terms_of(word) if t in self.number)
            self.met.add(word)
            if numbers:
                self.known[word] = numbers
                self.useful.add(word)
        found = Counter()
        for word in distinct & self.useful:
            for t in self.known[word]:
                found[t] += words[word]
        return found


@dataclass
class Index:
    """Block-max inverted index over unit vectors of the labelled examples."""

    vocabulary: Vocabulary
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    row: np.ndarray
    weight: np.ndarray
    offsets: np.ndarray
    block_max: np.ndarray
    k: int
    rate: float
    bare: float
    knots: np.ndarray | None = None
    values: np.ndarray | None = None
    # results by vector, as many texts hold the same terms
    remembered: dict[bytes, tuple[float, list[int]]] = field(default_factory=dict)

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(sorted(counts), np.int64, len(counts))
        value = (1 + np.log([counts[t] for t in at])) * self.idf[at] if len(at) else np.empty(0)
        return at, value / max(np.sqrt((value**2).sum()), 1e-12)

    def nearest(self, at: np.ndarray, value: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the ``k`` nearest examples with a positive cosine."""
        bounds = value @ self.block_max[at]
        order = np.argsort(-bounds, kind="stable")[: np.count_nonzero(bounds > 0)]
        rows, scores = np.empty(0, np.int64), np.empty(0)
        floor, done, step = 0.0, 0, 1
        while done < len(order):
            # twice as many blocks at a time, of those that can still hold a neighbour
            blocks = order[done : done + step]
            if len(rows) >= self.k:
                blocks = blocks[bounds[blocks] >= floor - 1e-9]
            if not len(blocks):
                break
            done, step = done + len(blocks), 2 * step
            start = self.offsets[np.ix_(at, blocks)]
            size = self.offsets[np.ix_(at, blocks + 1)] - start
            each = size.ravel()
            place = np.arange(int(each.sum())) + np.repeat(start.ravel() - (np.cumsum(each) - each), each)
            part = np.repeat(value, size.sum(1)) * self.weight[place]
            total = np.bincount(self.row[place], part, len(self.ids))
            if skip >= 0:
                total[skip] = 0
            hit = np.flatnonzero(total > 1e-12)
            rows, scores = np.concatenate([rows, hit]), np.concatenate([scores, total[hit]])
            best = np.lexsort((self.ids[rows], -np.round(scores, 12)))[: self.k]
            rows, scores = rows[best], scores[best]
            floor = scores[-1] if len(scores) >= self.k else 0.0
        return rows, scores

    def vote(self, rows: np.ndarray, scores: np.ndarray) -> float:
        weight = 1.0 / (np.maximum(0.0, 1.0 - scores) + 0.1)
        return float((weight @ self.labels[rows] + 0.5 * self.rate) / (weight.sum() + 0.5))

    def score(self, text: str) -> tuple[float, list[int]]:
        at, value = self.vector(self.vocabulary.counts(text))
        if not len(at):
            return self.bare, []
        key = at.tobytes() + value.tobytes()
        if key not in self.remembered:
            if len(self.remembered) >= HELD_VECTORS:
                self.remembered.clear()
            self.remembered[key] = self._voted(*self.nearest(at, value))
        return self.remembered[key]

    def _voted(self, rows: np.ndarray, scores: np.ndarray) -> tuple[float, list[int]]:
        if not len(rows):
            return self.rate, []
        return float(np.interp(self.vote(rows, scores), self.knots, self.values)), self.ids[rows].tolist()


def build(vocabulary: Vocabulary, frequency: dict[int, int], documents: int, examples: list, k: int, calibration_rows: int = CALIBRATION_ROWS) -> Index:
    """``examples`` are (id, label, {term: count}) rows, ids as integers."""
    size = len(vocabulary.number)
    df = np.array([frequency.get(t, 0) for t in range(size)], float)
    idf = np.log((1 + documents) / (1 + df)) + 1
    rate = (sum(y for _, y, _ in examples) + 1) / (len(examples) + 2)
    without = [y for _, y, c in examples if not c]
    bare = (sum(without) + 2 * rate) / (len(without) + 2)
    some = [e for e in examples if e[2]]
    # examples with the same strongest term lie together, which keeps block maxima tight
    some.sort(key=lambda e: (max(e[2], key=lambda t: (idf[t] * (1 + np.log(e[2][t])), t)), e[0]))
    blocks = max(1, -(-len(some) // BLOCK))
    draft = Index(vocabulary, idf, np.array([e[0] for e in some], np.int64), np.array([e[1] for e in some], float),
                  None, None, None, None, k, rate, bare)
    vectors = [draft.vector(Counter(e[2])) for e in some]
    row = np.repeat(np.arange(len(some)), [len(a) for a, _ in vectors])
    term = np.concatenate([a for a, _ in vectors]) if some else np.empty(0, np.int64)
    weight = np.concatenate([v for _, v in vectors]) if some else np.empty(0)
    order = np.lexsort((row, term))
    draft.row, draft.weight, term = row[order], weight[order], term[order]
    slot = term * blocks + draft.row // BLOCK
    edges = np.searchsorted(slot, np.arange(size * blocks + 1))
    draft.offsets = np.stack([edges[b : size * blocks : blocks][:size] for b in range(blocks)] + [edges[blocks::blocks][:size]], 1) if size else np.zeros((0, blocks + 1), np.int64)
    draft.block_max = np.zeros((size, blocks))
    np.maximum.at(draft.block_max, (term, draft.row // BLOCK), draft.weight)
    votes = []
    for i in range(0, len(some), max(1, -(-len(some) // calibration_rows))):
        rows, scores = draft.nearest(*vectors[i], skip=i)
        if len(rows):
            votes.append((draft.vote(rows, scores), draft.labels[i]))
    raw = np.array(votes).reshape(-1, 2)
    draft.knots, draft.values = monotone(raw[:, 0], raw[:, 1], rate)
    return draft


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    usable: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
    vocabulary: int = VOCABULARY,
    k: int = NEIGHBOURS,
    near_percent: int = NEAR_PERCENT,
    least_odds: float = LEAST_ODDS,
    prior_rows: float = PRIOR_ROWS,
    calibration_rows: int = CALIBRATION_ROWS,
) -> Index:
    """The index of the labelled rows that ``usable`` (over doc_id) admits."""
    rows = texts(docs, id_col, text_col)
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
        .where("doc_id IS NOT NULL AND y IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"), F.max("y").alias("z"))
        .where("y = z")
        .select("doc_id", "y")
    )
    if usable is not None:
        known = known.where(usable)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # at most sample_rows ids: the bound of this broadcast
    sample = stored(rows.join(F.broadcast(chosen), "doc_id").select("text", "y", "doc_id"), "labelled")
    # copies and near copies count once, else every word of a copied text would seem to matter
    if not sample.isEmpty():
        # with the label behind every word, sets of different labels have nothing in common
        marked = F.regexp_replace("text", F.lit(r"([^ \t\n\x0B\f\r]+)"), F.concat(F.lit("$1"), F.col("y").cast("string")))
        sample = one_of_each(sample.withColumn("marked", marked), text_col="marked", shingle=3, percent=near_percent)
        sample = sample.drop("marked")
    sample = stored(sample, "examples")
    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("n1")).first()
    n, n1 = totals.n, totals.n1
    picked: list[str] = []
    if 0 < n1 < n:
        a, b = F.col("n1"), F.col("n") - F.col("n1")
        gap = (a * (n - n1) - b * n1).cast("double")
        chi = F.lit(float(n)) * gap * gap / (F.col("n") * (n - F.col("n")).cast("double") * float(n1) * float(n - n1))
        share = float(n1) / n
        odds = (a + prior_rows * share) / (b + prior_rows * (1 - share)) * ((1 - share) / share)
        counted = (
            sample.select("text", "y")
            .mapInArrow(_count_terms, "term string, n long, n1 long")
            .groupBy("term")
            .agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
            .where((F.col("n") >= 5) & (F.col("n") < n))
            .withColumn("chi", chi)
            .where((odds >= least_odds) | (odds <= 1 / least_odds))
        )
        picked = [r.term for r in counted.orderBy(F.desc("chi"), "term").limit(vocabulary).collect()]
    words = Vocabulary(sorted(picked))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs_ = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(words.counts(text).keys())
                docs_ += 1
        seen[-1] = docs_
        yield pa.record_batch([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], ["t", "n"])

    counts = rows.select("text").mapInArrow(frequencies, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    frequency = {r.t: r.n for r in counts.collect()}  # a row per vocabulary term at most

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words.counts(t) for t in batch.column(0).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(2),
                    batch.column(1),
                    pa.array([list(c.keys()) for c in found], pa.list_(pa.int64())),
                    pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
                ],
                ["id", "y", "t", "c"],
            )

    examples = [
        (r.id, r.y, dict(zip(r.t, r.c)))
        for r in sample.withColumn("doc_id", F.col("doc_id").cast("long"))
        .mapInArrow(described, "id long, y int, t array<long>, c array<long>")
        .collect()
    ]
    return build(words, frequency, frequency.get(-1, 0), sorted(examples, key=lambda e: (e[0], e[1])), k, calibration_rows)


def scored(docs: DataFrame, index: Index, *, text_col: str = "text") -> DataFrame:
    """The documents with a struct column ``toxicity`` of (score, evidence ids).

    It takes the place of a column of that name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def toxicity(text):
        import pandas as pd

        index = shared.value
        found = [index.score(t) for t in text.fillna("")]
        return pd.DataFrame({"score": [f[0] for f in found], "evidence": [f[1] for f in found]})

    # not deterministic to the planner: run once, however many parts of it are asked for
    once = F.pandas_udf(toxicity, "score double, evidence array<long>").asNondeterministic()
    return docs.withColumn("toxicity", once(F.col(text_col)))
