"""Language identification by family first, then one-versus-one inside the family.

A whole text becomes a hashed histogram of letter trigrams, square-rooted and scaled to
length one. Linear support vector machines with squared hinge loss choose the language
family (one against the rest), then each pair of languages of that family votes; equal
votes go to the larger summed margin, then to the smaller code. ``score`` is the product
of the family's and the winner's probabilities, whose slopes are fitted on the training
rows left out of the machines.

Training reads at most ``sample_rows`` rows with a language (chosen by a hash of id and
language, with the same bound for every language, so rare ones are learned too). A null text or one
without letters is ``und`` with score 0; so is every text if nothing can be learned. A
family that has one learned language needs no second step. Rows may repeat.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 4_000
SLOTS = 2048
LETTER = re.compile(r"[^\W\d_]")
# Language codes by family; any other code is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi ur bn pa gu mr ne",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def histogram(text: str) -> np.ndarray:
    """Counts of hashed letter trigrams of the lower-cased text; other characters part words."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _LETTERS[np.minimum(codes, len(_LETTERS) - 1)]
    padded = np.concatenate([[0], np.where(letters, codes, 0), [0]]).astype(np.uint32)
    a, b, c = padded[:-2], padded[1:-1], padded[2:]
    mixed = ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77)) ^ (c * np.uint32(0xC2B2AE3D)))[b != 0]
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return np.bincount(mixed >> np.uint32(21), minlength=SLOTS)


_LETTERS = np.array([chr(i).isalpha() or 0xD800 <= i < 0xE000 for i in range(0x10000)] + [True])


def scaled(counts: np.ndarray) -> np.ndarray:
    root = np.sqrt(counts.astype(np.float32))
    return root / np.maximum(np.linalg.norm(root, axis=-1, keepdims=True), 1e-9)


def _machine(x: np.ndarray, y: np.ndarray, steps: int = 80, cost: float = 20.0) -> np.ndarray:
    """Weights and offset of a linear machine for y in {-1, 1}; both classes weigh the same."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    velocity, vb = np.zeros_like(w), 0.0
    rate = 1.0 / (1.0 / cost + 2.0)
    for _ in range(steps):
        look, lb = w + 0.9 * velocity, b + 0.9 * vb
        slack = np.maximum(0.0, 1.0 - y * (x @ look + lb)) * weight * y
        velocity = 0.9 * velocity + rate * (2 * (slack.astype(np.float32) @ x) - look / cost * 0.1)
        vb = 0.9 * vb + rate * 2 * slack.sum()
        w, b = w + velocity, b + vb
    return np.concatenate([w, [b]]).astype(np.float32)


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    members: dict[str, list[str]] = field(default_factory=dict)
    family: dict[str, np.ndarray] = field(default_factory=dict)
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)
    slopes: tuple[float, float] = (2.0, 2.0)


def _margin(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def _sure(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _slope(margins: np.ndarray, right: np.ndarray) -> float:
    """The slope on a grid with the least log loss."""
    if not len(margins):
        return 2.0
    grid = 2.0 ** np.arange(-2, 5, 0.5)
    loss = [-np.mean(np.log(np.maximum(1e-6, np.where(right, _sure(s * margins), 1 - _sure(s * margins))))) for s in grid]
    return float(grid[int(np.argmin(loss))])


def fit(counts: np.ndarray, langs: list[str]) -> Model:
    model = Model()
    if not len(langs):
        return model
    x, names = scaled(counts), np.array(langs)
    group = np.array([FAMILY_OF.get(n, n) for n in langs])
    model.families = sorted(set(group))
    model.members = {f: sorted(set(names[group == f])) for f in model.families}
    hold = np.arange(len(names)) % 6 == 5
    for side in (~hold, np.ones(len(names), bool)):
        if len(model.families) > 1:
            model.family = {f: _machine(x[side], np.where(group[side] == f, 1, -1)) for f in model.families}
        for members in model.members.values():
            for a, b in combinations(members, 2):
                pick = side & ((names == a) | (names == b))
                model.pairs[a, b] = _machine(x[pick], np.where(names[pick] == a, 1, -1))
        if side.all() or not hold.any():
            break
        margins, right = [], []
        for f, w in model.family.items():
            margins.append(_margin(x[hold], w))
            right.append(group[hold] == f)
        first = _slope(np.concatenate(margins), np.concatenate(right)) if margins else 2.0
        margins, right = [], []
        for (a, b), w in model.pairs.items():
            pick = hold & ((names == a) | (names == b))
            margins.append(_margin(x[pick], w))
            right.append(names[pick] == a)
        second = _slope(np.concatenate(margins), np.concatenate(right)) if margins else 2.0
        model.slopes = (first, second)
    return model


def predict(model: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and probability of each scaled histogram."""
    n = len(x)
    out, score = np.full(n, "und", dtype=object), np.zeros(n)
    if not model.families or not n:
        return out, score
    if len(model.families) > 1:
        sure = np.stack([_sure(model.slopes[0] * _margin(x, model.family[f])) for f in model.families], 1)
        best = sure.argmax(1)
        score = sure[np.arange(n), best] / np.maximum(sure.sum(1), 1e-12)
    else:
        best, score = np.zeros(n, int), np.ones(n)
    for k, name in enumerate(model.families):
        rows = np.flatnonzero(best == k)
        members = model.members[name]
        votes, total, sure = (np.zeros((len(rows), len(members))) for _ in range(3))
        for (i, a), (j, b) in combinations(enumerate(members), 2):
            m = _margin(x[rows], model.pairs[a, b])
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            total[:, i] += m
            total[:, j] -= m
            sure[:, i] += _sure(model.slopes[1] * m)
            sure[:, j] += _sure(-model.slopes[1] * m)
        won = (votes + 0.5 * (1 + np.tanh(total / (1 + np.abs(total))))).argmax(1) if len(rows) else np.empty(0, int)
        out[rows] = np.array(members, dtype=object)[won]
        if len(members) > 1 and len(rows):
            score[rows] *= sure[np.arange(len(rows)), won] / (len(members) - 1)
    return out, score


def train(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    usable: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    if usable is not None:
        rows = rows.where(usable)
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    langs = [r.lang for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample_rows).collect()]
    if not langs:
        return Model()
    # thresholds on the hash of the id leave about the wanted number of each language
    share = max(1, sample_rows // len(langs))
    picked = None
    for lang in langs:
        part = rows.where(F.col("lang") == lang).select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
        part = part.orderBy("h", "doc_id").limit(share)
        picked = part if picked is None else picked.unionByName(part)
    chosen = picked.select("doc_id", "lang").distinct()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [
                zlib.compress(np.minimum(histogram(t), 65535).astype("<u2").tobytes(), 1) if LETTER.search(t) else None
                for t in batch.column(0).to_pylist()
            ]
            yield pa.record_batch([batch.column(1), batch.column(2), pa.array(packed, pa.binary())], ["h", "lang", "x"])

    # at most sample_rows ids: the bound of this broadcast
    found = (
        rows.join(F.broadcast(chosen), ["doc_id", "lang"])
        .select("text", F.xxhash64("doc_id", "text").alias("h"), "lang")
        .mapInArrow(counted, "h long, lang string, x binary")
        .where("x IS NOT NULL")
        .collect()
    )
    found.sort(key=lambda r: (r.h, r.lang))
    counts = np.array([np.frombuffer(zlib.decompress(r.x), "<u2") for r in found]).reshape(-1, SLOTS)
    return fit(counts, [r.lang for r in found])


def predicted(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The documents with a struct column ``language`` of (lang_pred, score).

    It takes the place of a column of that name.
    """

    def language(text):
        import pandas as pd

        many = text.fillna("").tolist()
        lang, score = np.full(len(many), "und", dtype=object), np.zeros(len(many))
        for at in range(0, len(many), 512):
            rows = [i for i in range(at, min(at + 512, len(many))) if LETTER.search(many[i])]
            if rows:
                lang[rows], score[rows] = predict(model, scaled(np.stack([histogram(many[i]) for i in rows])))
        return pd.DataFrame({"lang_pred": lang, "score": score})

    # not deterministic to the planner: run once, however many parts of it are asked for
    once = F.pandas_udf(language, "lang_pred string, score double").asNondeterministic()
    return docs.withColumn("language", once(F.col(text_col)))
