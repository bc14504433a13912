"""Personal data: wide generators propose spans, boosted trees decide.

The base patterns and their checks are always reported. Wider generators propose further,
overlapping spans: addresses written out, local phone numbers, phone and card numbers
inside longer runs, account and identity numbers, long network addresses. Every proposal
is described by its family, its format, its family's check and its surroundings.

Boosted trees learn from proposals whose meaning the corpus itself tells. Base proposals
teach by their checks. A wide proposal teaches 1 if it lies in a valid base span of its
family, or if its value is that of a valid base span of its family anywhere in the corpus;
0 if it lies in a valid base span of another family or is a base proposal that fails. All
others are undecided: the trees judge them. Thresholds are calibrated by family: the lowest
one, from 0.5 on, that keeps the wanted precision on proposals left out of the fit;
families without both sorts among those take the threshold of all together. Spans over it
are selected, the surest first, none over a chosen one.

Proposals are counted by their description over all documents. Training reads every
distinct description, weighted by its counts, and leaves whole descriptions out of the fit:
cuts, trees and thresholds come from Spark jobs over all of them, of which the driver sees sums. Only
where ``sample_rows`` is given are that many of each sort (the smallest hashes) read on
the driver instead. Candidates of all documents are scored. With fewer than two descriptions of a sort nothing is added, which is warned
of where there are proposals to learn from. A null or
empty text has no spans. Offsets are code points, ends exclusive. Repeated rows each keep
their own result.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import boosting
from riskloom.llm.common import stored, texts
from riskloom.plans.ordering import percentiles_of, running_totals

PRECISION = 0.98
ROWS_PER_INTERVAL = 100_000
BASE = ("email", "ip", "card", "phone")
WIDE = {
    "email_text": re.compile(
        r"[A-Za-z0-9._%+-]{1,64}(?:\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}"
        r"(?:(?:\x20?[\[(]dot[\])]\x20?|\.)[A-Za-z0-9-]{2,63})+"
        r"|\x20at\x20[A-Za-z0-9-]{1,63}(?:\x20dot\x20[A-Za-z0-9-]{2,63})+)"
    ),
    "phone_local": re.compile(
        r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,5}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z])"
    ),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b"),
    "identity": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "ip_long": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "phone_part": re.compile(
        r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,3}(?![0-9])"
    ),
    "card_part": re.compile(r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])"),
}
FAMILY = {
    "email": "email", "email_text": "email", "ip": "ip", "ip_long": "ip", "card": "card", "card_part": "card",
    "phone": "phone", "phone_local": "phone", "phone_part": "phone", "iban": "account", "identity": "identity",
}
FAMILIES = tuple(dict.fromkeys(FAMILY.values()))
KINDS = (*BASE, *WIDE)
RANK = {k: i for i, k in enumerate(KINDS)}
CUE = re.compile(
    r"(?i)mail|phone|tel|call|fax|mobile|contact|reach|address|server|host|card|visa|account|iban|ssn|born|name"
)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs: a start inside a run of digits can only fail as the run's start did.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from each at sign outwards so long runs stay linear."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, valid) of every base match, failing ones included."""
    if "@" in text:
        for start, stop in emails(text):
            yield "email", start, stop, True
    if not _DIGIT.search(text):
        return
    for m in IP.finditer(text):
        parts = m[0].split(".")
        yield "ip", m.start(), m.end(), all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in parts)
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        yield "card", m.start(), m.end(), 12 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 9 <= sum(c.isdigit() for c in m[0]) <= 15


_DIGIT = re.compile("[0-9]")
_WRITTEN = re.compile(r"[\[(]at[\])]|\x20dot\x20")
_AT = re.compile(r"\x20?[\[(]at[\])]\x20?|\x20at\x20")
_DOT = re.compile(r"\x20?[\[(]dot[\])]\x20?|\x20dot\x20")


def passes(kind: str, span: str) -> bool:
    """The check of the kind, of wide kinds too."""
    digits = "".join(c for c in span if "0" <= c <= "9")
    if kind == "iban":
        plain = span.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    if kind == "identity":
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
    if FAMILY[kind] == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone_local" or kind == "phone_part":
        return 7 <= len(digits) <= 15
    return True


def value_of(kind: str, span: str) -> int | None:
    """A hash of what the span says however it is written; None where that is not compared.

    Phone numbers compare by their last nine digits, with and without a country's code.
    """
    family = FAMILY[kind]
    if family == "email":
        plain = _DOT.sub(".", _AT.sub("@", span)).lower()
    elif family in ("card", "phone"):
        plain = "".join(c for c in span if "0" <= c <= "9")
        plain = plain[-9:] if family == "phone" else plain
        if len(plain) < 9:
            return None
    else:
        return None
    return int.from_bytes(hashlib.blake2b(f"{family}:{plain}".encode(), digest_size=8).digest(), "big", signed=True)


def described(text: str, kind: str, start: int, stop: int, valid: bool) -> list[float]:
    """Family, check and format of a span and what stands around it."""
    span, before, after = text[start : min(stop, start + 200)], text[max(0, start - 30) : start], text[stop : stop + 12]
    digits = [c for c in span if c.isdigit()]
    letters = sum(c.isalpha() for c in span)
    groups = re.findall(r"[0-9]+", span)
    return [
        *(family == FAMILY[kind] for family in FAMILIES),
        valid,
        stop - start,
        len(digits),
        letters,
        len(set(digits)),
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("("),
        span.count(":"),
        "@" in span or "at" in span.lower(),
        span[:1] == "+",
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        bool(CUE.search(before)),
        before[-1:].isspace() or not before,
        after[:1].isspace() or after[:1] in ".,;:)" or not after,
        before[-1:].isalnum(),
        after[:1].isalnum(),
        bool(digits) and letters == 0,
        # the span is a piece of a longer number
        before[-1:] in (".", "-", "/", ":") and before[-2:-1].isdigit(),
        after[:1] in (".", "-", "/", ":") and after[1:2].isdigit(),
    ]


FEATURES = len(FAMILIES) + 23
SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("stop", T.IntegerType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("valid", T.BooleanType()),
        T.StructField("taught", T.IntegerType()),
        T.StructField("value", T.LongType()),
        T.StructField("x", T.ArrayType(T.FloatType())),
    ]
)


def lesson(kind: str, start: int, stop: int, base: list[tuple[str, int, int, bool]], first: int) -> int | None:
    """What the base proposals of the text, from place ``first`` on, say of a wide one."""
    out = None
    for other, a, b, valid in base[first:]:
        if a >= stop:
            break
        if a <= start and stop <= b:
            if valid:
                return int(FAMILY[other] == FAMILY[kind])
            if (a, b) == (start, stop) and FAMILY[other] == FAMILY[kind]:
                out = 0
    return out


def proposed(text: str) -> list[dict]:
    """All proposals of a text; base proposals that fail are kept to learn from.

    ``taught`` is 1, 0 or None (undecided within this text).
    """
    base = sorted(base_proposals(text), key=lambda t: (t[1], RANK[t[0]]))
    # a short digit run is no proposal worth learning from, however many a text has
    base = [p for p in base if p[3] or p[2] - p[1] >= 7]
    out = [(start, RANK[kind], stop, True, valid, int(valid)) for kind, start, stop, valid in base]
    # up to each base proposal, how far the ones before it reach
    reach = list(itertools.accumulate((p[2] for p in base), max))
    written, digits = _WRITTEN.search(text), _DIGIT.search(text)
    if written or digits:
        for kind, pattern in WIDE.items():
            if written if kind == "email_text" else digits:
                for m in pattern.finditer(text):
                    first = bisect.bisect_right(reach, m.start())
                    taught = lesson(kind, m.start(), m.end(), base, first)
                    out.append((m.start(), RANK[kind], m.end(), False, passes(kind, m[0]), taught))
    out.sort(key=lambda t: t[:3])
    full = []
    for start, rank, stop, is_base, valid, taught in out:
        kind = KINDS[rank]
        # only what passes can confirm, or be confirmed by, another
        value = value_of(kind, text[start:stop]) if valid else None
        x = [float(v) for v in described(text, kind, start, stop, valid)]
        full.append(dict(zip(SPAN.names, (start, rank, stop, is_base, valid, taught, value, x))))
    return full


def select(spans: list[dict], model: boosting.Boosted | None, thresholds: np.ndarray) -> list[dict]:
    """The valid base spans and the further ones the trees are sure of.

    The surest come first, then the longest, so a part does not displace its whole.
    """
    chosen = [s for s in spans if s["base"] and s["valid"]]
    wide = [s for s in spans if not s["base"]]
    if model is None or not wide:
        return chosen
    sure = model.predict(np.array([s["x"] for s in wide], float))
    least = np.array([thresholds[FAMILIES.index(FAMILY[KINDS[s["rank"]]])] for s in wide])
    # chosen spans are disjoint but for base ones, so a sorted list of merged runs suffices
    runs: list[tuple[int, int]] = []
    for s in sorted(chosen, key=lambda s: s["start"]):
        if runs and s["start"] < runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], s["stop"]))
        else:
            runs.append((s["start"], s["stop"]))
    order = sorted(
        np.flatnonzero(sure >= least),
        key=lambda i: (-sure[i], wide[i]["start"] - wide[i]["stop"], wide[i]["start"], wide[i]["rank"]),
    )
    for i in order:
        s = wide[i]
        at = bisect.bisect_right(runs, (s["start"], s["stop"]))
        if (at == 0 or runs[at - 1][1] <= s["start"]) and (at == len(runs) or s["stop"] <= runs[at][0]):
            chosen.append(s)
            runs.insert(at, (s["start"], s["stop"]))
    return sorted(chosen, key=lambda s: (s["start"], s["rank"], s["stop"]))


def held_out(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Every fourth distinct description of each sort, equal ones always together."""
    sorts: dict[tuple, int] = {}
    for row, label in zip(map(tuple, x), y):
        sorts[row] = sorts.get(row, 0) | (2 if label else 1)
    met, out = [0] * 4, {}
    for row, sort in sorts.items():
        # the second already, so that two suffice
        out[row] = met[sort] % 4 == 1
        met[sort] += 1
    return np.array([out[row] for row in map(tuple, x)], bool)


def threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray, precision: float) -> float:
    """The lowest threshold from 0.5 on that keeps ``precision``; above 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    p, y, weight = p[order], y[order], weight[order]
    share = np.cumsum(weight * y) / np.cumsum(weight)
    # a threshold takes all of equal probability
    last = np.append(np.diff(p) != 0, True)
    over = np.flatnonzero(last & (p >= 0.5))
    if not len(over) or share[over[-1]] >= precision:
        return 0.5
    good = over[share[over] >= precision]
    return float(p[good[-1]]) if len(good) else 2.0


def fit(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, precision: float = PRECISION
) -> tuple[boosting.Boosted | None, np.ndarray]:
    """Trees on three quarters of the descriptions, and a threshold for each family from the rest."""
    hold = held_out(x, y)
    if len(set(y[~hold])) < 2 or len(set(y[hold])) < 2:
        return None, np.full(len(FAMILIES), 2.0)
    model = boosting.fit(x[~hold], y[~hold], weight[~hold])
    x, y, weight = x[hold], y[hold], weight[hold]
    p = model.predict(x)
    out = np.full(len(FAMILIES), threshold(p, y, weight, precision))
    for i in range(len(FAMILIES)):
        own = x[:, i] > 0
        if len(set(y[own])) == 2:
            out[i] = threshold(p[own], y[own], weight[own], precision)
    return model, out


def descriptions(rows: DataFrame) -> DataFrame:
    """(x, n1, n0): how often each description teaches 1 and 0, over all proposals."""
    each = rows.select(F.explode("found").alias("f")).select("f.*")
    # values confirmed by a base span; a frequent one is a row for each task and description
    agreed = each.where("base AND valid AND value IS NOT NULL").select("value").distinct()
    met = each.groupBy("x", "value").agg(
        F.count_if(F.col("taught") == 1).alias("n1"),
        F.count_if(F.col("taught") == 0).alias("n0"),
        F.count_if(F.col("taught").isNull()).alias("open"),
    )
    met = met.join(agreed.withColumn("agreed", F.lit(True)), "value", "left")
    return stored(
        met.groupBy("x").agg(
            F.sum(F.col("n1") + F.when(F.col("agreed"), F.col("open")).otherwise(0)).alias("n1"),
            F.sum("n0").alias("n0"),
        ),
        "descriptions",
        compact=True,
    )


def learning_sample(rows: DataFrame, sample_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Descriptions, lessons and weights of the proposals that teach.

    The weights of a sort sum to all its proposals, also where its sample is a part.
    """
    counts = descriptions(rows)
    total = counts.agg(F.sum("n0"), F.sum("n1")).first()
    x, y, weight = [], [], []
    for label, name in enumerate(("n0", "n1")):
        some = counts.where(F.col(name) > 0).select("x", F.col(name).alias("n"))
        picked = some.orderBy(F.xxhash64("x"), "x").limit(sample_rows).collect()
        read = sum(r.n for r in picked)
        x += [r.x for r in picked]
        y += [bool(label)] * len(picked)
        weight += [r.n * (total[label] / read) for r in picked]
    return np.array(x, float).reshape(-1, FEATURES), np.array(y, bool), np.array(weight, float)


def with_held_out(counts: DataFrame) -> DataFrame:
    """The descriptions that teach, with ``hold`` as :func:`held_out` says it, in the order of a hash.

    The rank in a sort is taken within intervals of the hash; earlier intervals add their rows.
    """
    sort = F.when(F.col("n0") > 0, 1).otherwise(0) + F.when(F.col("n1") > 0, 2).otherwise(0)
    rows = counts.withColumn("sort", sort).where("sort > 0").withColumn("h", F.xxhash64("x"))
    intervals = rows.count() // ROWS_PER_INTERVAL + 1
    rows = rows.withColumn("part", F.floor((F.col("h").cast("double") + 2.0**63) / (2.0**64 / intervals)))
    sizes = rows.groupBy("sort", "part").agg(F.count(F.lit(1)).alias("n"))
    # a row per interval of a sort
    earlier = Window.partitionBy("sort").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("sort", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("sort", "part").orderBy("h", "x")
    ranked = rows.withColumn("rank", F.row_number().over(inside) - 1).join(offsets, ["sort", "part"])
    return ranked.select("x", "n0", "n1", ((F.col("before") + F.col("rank")) % 4 == 1).alias("hold"))


def cuts_of(train: DataFrame) -> list[np.ndarray]:
    """Quantile cuts of every feature; a description counts once for each label it has."""
    times = F.when(F.col("n0") > 0, 1).otherwise(0) + F.when(F.col("n1") > 0, 1).otherwise(0)
    values = train.select(times.alias("times"), F.posexplode("x").alias("f", "v"))
    values = values.select("f", F.col("v").cast("double").alias("v"), "times")
    names = {f"q{i}": q for i, q in enumerate(boosting.quantile_steps())}
    found = percentiles_of(running_totals(values, ["f"], "v", {"n": F.col("times")}), ["f"], "v", names)
    # a row per feature
    at = {r.f: [r[q] for q in names] for r in found.collect()}
    return [np.unique(at[f]) for f in range(FEATURES)]


def thresholds_of(held: DataFrame, model: boosting.Boosted, precision: float) -> np.ndarray:
    """:func:`threshold` of every family over the rows (x, n0, n1), as running totals over the probabilities."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, FEATURES)
            family = x[:, : len(FAMILIES)].argmax(1).astype(np.int32)
            yield pa.record_batch(
                [pa.array(family), pa.array(-model.predict(x)), *batch.columns[1:]], ["family", "q", "n0", "n1"]
            )

    rows = held.select("x", "n0", "n1").mapInArrow(judged, "family int, q double, n0 long, n1 long")
    both = rows.select(F.explode(F.array(F.lit(-1), "family")).alias("family"), "q", "n0", "n1")
    both = stored(both.groupBy("family", "q").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "judged", compact=True)
    # the surest first: q is the probability below zero
    totals = running_totals(both, ["family"], "q", {"n0": F.col("n0"), "n1": F.col("n1")})
    good = F.col("before_n1") + F.col("n1")
    totals = totals.withColumn("share", good / (good + F.col("before_n0") + F.col("n0"))).withColumn("over", F.col("q") <= -0.5)
    found = totals.groupBy("family").agg(
        F.max(F.when(F.col("over"), F.struct("q", "share")))["share"].alias("whole"),
        F.max(F.when(F.col("over") & (F.col("share") >= precision), F.col("q"))).alias("q"),
        F.first((F.col("total_n0") > 0) & (F.col("total_n1") > 0)).alias("two"),
    )
    least = {}
    for r in found.collect():
        enough = r.whole is None or r.whole >= precision
        least[r.family] = (0.5 if enough else 2.0 if r.q is None else -r.q, r.two)
    return np.array([least[i][0] if least.get(i, (0, False))[1] else least[-1][0] for i in range(len(FAMILIES))])


def learn(rows: DataFrame, precision: float = PRECISION) -> tuple[boosting.Boosted | None, np.ndarray, bool]:
    """:func:`fit` over every distinct description, and whether there was anything to learn from."""
    known = stored(with_held_out(descriptions(rows)), "lessons", compact=True)
    sorts = known.groupBy("hold").agg(F.max("n0").alias("n0"), F.max("n1").alias("n1")).collect()
    if len(sorts) < 2 or any(r.n0 == 0 or r.n1 == 0 for r in sorts):
        return None, np.full(len(FAMILIES), 2.0), bool(sorts)
    train = known.where("NOT hold")
    cuts = cuts_of(train)

    def in_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, FEATURES)
            bins = [b.tobytes() for b in boosting.binned(x, cuts).astype(np.uint8)]
            yield pa.record_batch([pa.array(bins, pa.binary()), *batch.columns[1:]], ["bins", "n0", "n1"])

    # rows of equal bins are one row to the trees
    table = train.select("x", "n0", "n1").mapInArrow(in_bins, "bins binary, n0 long, n1 long")
    table = table.groupBy("bins").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).sortWithinPartitions("bins")
    model = boosting.fit_counts(stored(table, "bins", compact=True), cuts)
    return model, thresholds_of(known.where("hold"), model, precision), True


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample_rows: int | None = None) -> DataFrame:
    """One row per document: (doc_id, spans), each (start, stop, kind, base).

    ``sample_rows`` bounds the distinct descriptions of each sort that are learnt from;
    without it all are.
    """
    id_type = docs.schema[id_col].dataType

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("stop", pa.int32()), ("base", pa.bool_()), ("valid", pa.bool_()), ("taught", pa.int32()), ("value", pa.int64()), ("x", pa.list_(pa.float32()))]))
        for batch in batches:
            found = [proposed(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, kind)], ["doc_id", "found"])

    out_type = T.StructType([T.StructField("doc_id", id_type), T.StructField("found", T.ArrayType(SPAN))])
    rows = stored(texts(docs, id_col, text_col).mapInArrow(propose, out_type), "proposals")
    if sample_rows is None:
        model, thresholds, met = learn(rows)
    else:
        x, y, weight = learning_sample(rows, sample_rows)
        (model, thresholds), met = fit(x, y, weight), bool(len(y))
    if model is None and met:
        warnings.warn("personal data: proposals do not suffice to learn from, no further spans", stacklevel=2)

    @F.pandas_udf("array<struct<start:int,stop:int,kind:string,base:boolean>>")
    def chosen(found):
        import pandas as pd

        return pd.Series(
            [
                [
                    {"start": s["start"], "stop": s["stop"], "kind": KINDS[s["rank"]], "base": bool(s["base"])}
                    for s in select(list(spans), model, thresholds)
                ]
                for spans in found
            ]
        )

    empty = F.array().cast("array<struct<start:int,stop:int,kind:string,base:boolean>>")
    some = rows.where(F.size("found") > 0).select("doc_id", chosen("found").alias("spans"))
    return rows.where(F.size("found") == 0).select("doc_id", empty.alias("spans")).unionByName(some)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    )
