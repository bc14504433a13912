"""Removal of long repeated byte strings by bounded interval expansion on a BWT.

A string of ``length`` bytes that starts at two or more places is removed at all of them.
Texts are cut into work by anchors: the smallest hash among the ``gram``-byte strings
inside a window of ``length`` bytes depends on the window alone, so equal windows share
their anchor and meet in its bucket, wherever they start. A bucket holds the distinct
segments around its anchor with their counts; a bucket of one segment is settled by the
count, every other one by an index:

* the suffixes of the bucket's segments are sorted and their Burrows-Wheeler transform
  taken;
* breadth-first backward extension turns intervals of equal prefixes of l bytes into those
  of l + 1, which yields the common prefixes of neighbours by increasing value;
* at ``length`` it stops: neighbours without a value share ``length`` bytes or more.

A bucket with more than ``bucket_bytes`` of distinct segments is dealt again by longer
grams, at last by whole windows, where only equal segments share a bucket. Segments are
counted with map-side partial sums, so copies cost one row per task. Bytes are fetched
only for texts that hold an open bucket and only removals touch a text again.

A null text is empty. Texts shorter than ``length`` lose nothing. Matches never cross
texts; repeated rows repeat each other's strings. Null ids are allowed.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import bit_set, might_hold, stored
from riskloom.llm.minhash import _mix, _powers

LENGTH = 400
GRAMS = (64, 224, 336)
BUCKET_BYTES = 1 << 20
PACK_BYTES = 1 << 20
CHUNK = 4 << 20
_PLACE = np.uint64((1 << 24) - 1)


def anchors(raw: np.ndarray, length: int, gram: int):
    """Runs of window starts with one anchor: (h, g, lo, n) arrays.

    ``h`` hashes the anchor's gram, ``g`` the bytes of the run's windows, ``lo`` is the
    first start and ``n`` the number of starts. Long texts go in chunks of starts.
    """
    starts = len(raw) - length + 1
    parts = [
        _anchors(raw[at : min(at + CHUNK, starts) + length - 1], length, gram, at) for at in range(0, max(starts, 0), CHUNK)
    ]
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _anchors(raw: np.ndarray, length: int, gram: int, base: int):
    width = length - gram + 1
    up, down = _powers(1 << max(16, (len(raw) + 1).bit_length()))
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=total[1:])
    grams = len(raw) - gram + 1
    hashed = _mix((total[gram:] - total[:grams]) * down[:grams])
    ranked = (hashed & ~_PLACE) | np.arange(grams, dtype=np.uint64)
    padded = np.full(-(-grams // width) * width, ~np.uint64(0))
    padded[:grams] = ranked
    table = padded.reshape(-1, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = grams - width + 1
    place = (np.minimum(backward[:starts], forward[width - 1 : width - 1 + starts]) & _PLACE).astype(np.int64)
    lo = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
    n = np.diff(np.concatenate([lo, [starts]]))
    stop = lo + n - 1 + length
    g = _mix((total[stop] - total[lo]) * down[lo] + n.astype(np.uint64))
    return hashed[place[lo]].view(np.int64), g.view(np.int64), lo + base, n


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by at least ``depth`` bytes, and where their first 8 bytes change."""
    size = len(text)
    key = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        key = (key[:-step] << np.uint64(8 * step)) | key[step:]
    key = key[:size]
    order = np.argsort(key, kind="stable")
    change = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    eight = change
    done = 8
    while done < depth and not change.all():
        rank = np.empty(size, np.int64)
        rank[order] = np.cumsum(change)
        after = np.zeros(size, np.int64)
        after[:-done] = rank[done:] if done < size else 0
        both = rank * (size + 1) + after
        order = np.argsort(both, kind="stable")
        change = np.concatenate([[True], both[order][1:] != both[order][:-1]])
        done *= 2
    return order, eight


def long_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, class): sorted suffixes, those sharing ``length`` bytes with one number.

    Zero bytes part the segments and are never extended over.
    """
    size = len(text)
    order, eight = suffix_order(text, length)
    last_bytes = text[order - 1]
    by_byte = np.argsort(last_bytes, kind="stable")
    step = np.empty(size, np.int64)
    step[by_byte] = np.arange(size)
    same = last_bytes[by_byte][1:] == last_bytes[by_byte][:-1]
    following, previous = np.full(size, size), np.full(size, -1)
    following[by_byte[:-1][same]] = by_byte[1:][same]
    previous[by_byte[1:][same]] = by_byte[:-1][same]
    known = np.concatenate([eight, [True]])
    edges = np.flatnonzero(known)
    low, high = edges[:-1], edges[1:]
    # an interval holds the suffixes with one prefix; all those of 8 bytes come first
    for _ in range(8, length):
        if not len(low):
            break
        sizes = high - low
        at = np.arange(int(sizes.sum())) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        inside = last_bytes[at] != 0
        ends = inside & (following[at] >= np.repeat(high, sizes))
        begins = inside & (previous[at] < np.repeat(low, sizes))
        high = np.sort(step[at[ends]]) + 1
        low = np.sort(step[at[begins]])
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
    return order, np.cumsum(known[:size])


def repeated_starts(segments: list[bytes], counts: list[int], length: int) -> list[list[tuple[int, int]]]:
    """Runs [a, b) of the starts in each segment whose ``length`` bytes occur twice or more."""
    sizes = np.array([len(s) for s in segments])
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    # zero is the mark between segments, so bytes move up; 255 never occurs in UTF-8
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = text + np.uint8(1)
    text[begin + sizes] = 0
    weight = np.zeros(len(text), np.int64)
    own = sizes - length + 1
    at = np.arange(int(own.sum())) + np.repeat(begin - (np.cumsum(own) - own), own)
    weight[at] = np.repeat(np.minimum(counts, 2), own)
    order, classes = long_classes(text, length)
    twice = np.bincount(classes, weight[order]) >= 2
    found = np.zeros(len(text), bool)
    found[order] = twice[classes]
    found &= weight > 0
    out = []
    for b, n in zip(begin, own):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], found[b : b + n], [False]]).view(np.int8)))
        out.append([(int(x), int(y)) for x, y in edge.reshape(-1, 2)])
    return out


_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _indexed(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Whole buckets, sorted by ``h``, are packed into one index of bounded size."""
    rows: list[tuple] = []
    held = 0

    def settle(part: list[tuple]) -> pa.RecordBatch:
        found = repeated_starts([r[3] for r in part], [r[2] for r in part], length)
        return pa.record_batch(
            [
                pa.array([r[0] for r in part], pa.int64()),
                pa.array([r[1] for r in part], pa.int64()),
                pa.array([[{"a": a, "b": b} for a, b in f] for f in found], _RANGES),
            ],
            ["h", "g", "ranges"],
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held >= PACK_BYTES and row[0] != rows[-1][0]:
                yield settle(rows)
                rows, held = [], 0
            rows.append(row)
            held += len(row[3])
    if rows:
        yield settle(rows)


def _settled(segments: DataFrame, length: int, grams: tuple[int, ...], bucket_bytes: int) -> DataFrame:
    """(h, g, ranges) for distinct segments (h, g, m, bytes) of stored buckets."""
    size = F.sum(F.length("bytes").cast("long"))
    buckets = stored(
        segments.groupBy("h").agg(
            F.sum("m").alias("total"), F.count(F.lit(1)).alias("kinds"), size.alias("size")
        ),
        "buckets",
    )
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.length("bytes") - length + 1).alias("b")))
    alone = segments.join(buckets.where("kinds = 1 AND total > 1").select("h"), "h", "left_semi")
    settled = alone.select("h", "g", whole.alias("ranges"))
    big = buckets.where((F.col("kinds") > 1) & (F.col("size") > bucket_bytes)).select("h")
    small = buckets.where((F.col("kinds") > 1) & (F.col("size") <= bucket_bytes)).select("h")
    parts = max(1, int((buckets.agg(F.sum("size")).first()[0] or 0) // (4 * PACK_BYTES)))
    settled = settled.unionByName(
        segments.join(small, "h", "left_semi")
        .select("h", "g", "m", "bytes")
        .repartition(parts, "h")
        .sortWithinPartitions("h")
        .mapInArrow(lambda b: _indexed(b, length), "h long, g long, ranges array<struct<a:int,b:int>>")
    )
    if big.isEmpty():
        return settled
    gram, rest = (grams[0], grams[1:]) if grams else (length, ())

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ph, pg, m, raw in zip(*(c.to_pylist() for c in batch.columns)):
                h, g, lo, n = anchors(np.frombuffer(raw, np.uint8), length, gram)
                k = len(h)
                pieces = [raw[a : a + b + length - 1] for a, b in zip(lo.tolist(), n.tolist())]
                columns = [np.full(k, ph), np.full(k, pg), np.full(k, m), h, g, lo]
                yield pa.record_batch(
                    [*(pa.array(c, pa.int64()) for c in columns), pa.array(pieces, pa.binary())],
                    ["ph", "pg", "m", "h", "g", "lo", "bytes"],
                )

    finer = stored(
        segments.join(big, "h", "left_semi")
        .select("h", "g", "m", "bytes")
        .mapInArrow(dealt, "ph long, pg long, m long, h long, g long, lo long, bytes binary"),
        "finer",
    )
    merged = finer.groupBy("h", "g").agg(F.sum("m").alias("m"), F.first("bytes").alias("bytes"))
    below = stored(_settled(stored(merged, "segments"), length, rest, bucket_bytes), "settled")
    lifted = (
        finer.select("ph", "pg", "lo", "h", "g")
        .join(below, ["h", "g"])
        .groupBy("ph", "pg")
        .agg(
            F.flatten(
                F.collect_list(
                    F.transform(
                        "ranges",
                        lambda r: F.struct(
                            (r["a"] + F.col("lo")).cast("int").alias("a"), (r["b"] + F.col("lo")).cast("int").alias("b")
                        ),
                    )
                )
            ).alias("ranges")
        )
    )
    return settled.unionByName(lifted.select(F.col("ph").alias("h"), F.col("pg").alias("g"), "ranges"))


def removals(docs: DataFrame, *, text_col: str = "text", length: int = LENGTH, grams: tuple[int, ...] = GRAMS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(k, spans): for each text, named by ``text_name``, the byte runs to remove."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    base = docs.select(text_name(F.col(text_col)).alias("k"), body.alias("raw")).where(F.length("raw") >= length)

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [anchors(np.frombuffer(r, np.uint8), length, grams[0]) for r in batch.column(1).to_pylist()]
            sizes = [len(r[0]) for r in runs]
            h, g, lo, n = (np.concatenate([r[i] for r in runs]) for i in range(4))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            rows = pa.StructArray.from_arrays(
                [pa.array(h), pa.array(g), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32))],
                ["h", "g", "lo", "n"],
            )
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(offsets, rows)], ["k", "runs"])

    runs = stored(
        base.mapInArrow(anchored, "k binary, runs array<struct<h:long,g:long,lo:int,n:int>>"), "anchors"
    )
    each = runs.select("k", F.explode("runs").alias("r")).select("k", "r.h", "r.g", "r.lo", "r.n")
    shared = stored(
        each.groupBy("h")
        .agg(F.count(F.lit(1)).alias("m"), F.min("g").alias("low"), F.max("g").alias("high"))
        .where("m > 1")
        .select("h", (F.col("low") != F.col("high")).alias("open")),
        "shared",
    )
    met = stored(each.join(shared, "h"), "met")
    wanted = stored(
        met.where("open").groupBy("h", "g").agg(
            F.count(F.lit(1)).alias("m"), F.min(F.struct("k", "lo", "n")).alias("at")
        ).select("h", "g", "m", "at.k", "at.lo", "at.n"),
        "wanted",
    )
    filtered = base.where(might_hold(F.xxhash64("k"), bit_set(wanted.select(F.xxhash64("k").alias("h")))))
    one = filtered.join(wanted.select("k").distinct(), "k", "left_semi").dropDuplicates(["k"])
    segments = stored(
        one.join(wanted, "k").select(
            "h", "g", "m", F.substring("raw", F.col("lo") + 1, F.col("n") + (length - 1)).alias("bytes")
        ),
        "segments",
    )
    settled = stored(_settled(segments, length, grams[1:], bucket_bytes), "settled")
    spread = met.where("open").join(settled, ["h", "g"]).select(
        "k", F.explode("ranges").alias("r"), "lo"
    ).select("k", (F.col("lo") + F.col("r.a")).alias("a"), (F.col("lo") + F.col("r.b")).alias("b"))
    plain = met.where("NOT open").select("k", F.col("lo").alias("a"), (F.col("lo") + F.col("n")).alias("b"))
    starts = spread.unionByName(plain).groupBy("k").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("s"))
    grown = F.transform("s", lambda r: F.struct(r["a"].alias("start"), (r["b"] + (length - 1)).alias("stop")))
    return stored(starts.select("k", grown.alias("s")).select("k", _merged(F.col("s")).alias("spans")), "spans")


def _merged(spans: Column) -> Column:
    """Overlapping or touching spans, sorted by start, as maximal runs."""
    empty = F.array().cast("array<struct<start:int,stop:int>>")
    walked = F.aggregate(
        spans,
        F.struct(empty.alias("out"), F.lit(-1).alias("start"), F.lit(-1).alias("stop")),
        lambda acc, s: F.when(
            s["start"] <= acc["stop"],
            F.struct(acc["out"].alias("out"), acc["start"].alias("start"), F.greatest(acc["stop"], s["stop"]).alias("stop")),
        ).otherwise(
            F.struct(
                F.concat(acc["out"], F.filter(F.array(F.struct(acc["start"].alias("start"), acc["stop"].alias("stop"))), lambda x: x["start"] >= 0)).alias("out"),
                s["start"].alias("start"),
                s["stop"].alias("stop"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.array(F.struct(acc["start"].alias("start"), acc["stop"].alias("stop")))),
    )
    return walked


def text_name(text: Column) -> Column:
    """128 bits that equal texts share."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: (doc_id, n_bytes, spans, kept); ``kept`` is the rest as bytes."""
    spans = removals(docs, text_col=text_col, **options)
    text = F.coalesce(F.col(text_col), F.lit(""))
    body = text.cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_name(F.col(text_col)).alias("k"), body.alias("raw"))
    none = F.array().cast("array<struct<start:int,stop:int>>")
    size = F.length("raw").cast("long").alias("n_bytes")
    touched = might_hold(F.xxhash64("k"), bit_set(spans.select(F.xxhash64("k").alias("h"))))
    pieces = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<binary>").alias("out")),
        lambda acc, s: F.struct(
            s["stop"].alias("at"),
            F.concat(acc["out"], F.array(F.substring("raw", acc["at"] + 1, s["start"] - acc["at"]))).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.array(F.substring("raw", acc["at"] + 1, F.length("raw")))),
    )
    kept = F.unhex(F.array_join(F.transform(pieces, lambda p: F.hex(p)), ""))
    changed = (
        rows.where(touched)
        .join(spans, "k", "left")
        .withColumn("spans", F.coalesce("spans", none))
        .select("doc_id", size, "spans", F.when(F.size("spans") == 0, F.col("raw")).otherwise(kept).alias("kept"))
    )
    plain = rows.where(~touched).select("doc_id", size, none.alias("spans"), F.col("raw").alias("kept"))
    return plain.unionByName(changed)
