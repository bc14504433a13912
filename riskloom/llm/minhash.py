"""Near-duplicate documents by one-permutation MinHash with optimal densification.

A document's set holds its distinct word shingles. One pass hashes every shingle once;
the top bits of a hash choose its bin and the smallest hash of a bin is its value. Empty
bins borrow from a filled bin drawn at random per empty bin, so borrowed values of similar
sets agree as often as own ones. Runs of bins form bands; documents that share a band are
candidates.

Documents with equal sets are one class from the start. In each bucket every class is
paired with one hub (a star), which bounds the pairs by the bucket's size, and pairs are
confirmed on the full sets. A star alone can miss links between two members, so buckets
whose members still lie in several components go on: a second star with another hub, then
the pairs between different components, all of them in small buckets and those that share
one of their rarest shingles (an exact condition) in large ones. Pairs inside one
component cannot change the result and are never looked at.

Rows without words link with nothing. Rows with a null id take part; they cannot name a
component, so one without links to other ids has a null component and is kept. Repeated
rows are equal sets, each keeps its row.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import might_hold, row_key, stored, stored_bits, texts, tidy, unused
from riskloom.llm.components import components

BINS_LOG2 = 8
ROWS = 6
NO_ID = 2**63 - 1
SMALL_BUCKET = 12
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 2**64))
    up, down = np.full(size, _BASE), np.full(size, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@functools.lru_cache(maxsize=1)
def _spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, *range(9, 14)]] = True
    return table


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, after lower-casing A-Z."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    space = _spaces()[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
    start, stop = edge[::2], edge[1::2]
    up, down = _powers(1 << max(16, (len(raw) + 1).bit_length()))
    total = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])])
    return _mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    size = min(n, shingle)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total = _mix(total * _BASE + words[i : n - size + 1 + i])
    return np.unique(total)


@functools.lru_cache(maxsize=4)
def _draws(bins: int) -> np.ndarray:
    """For each bin the order in which it looks for a filled one."""
    rng = np.random.default_rng(20_240_601)
    return np.argsort(rng.random((bins, bins)), axis=1)


def signature(members: np.ndarray, bins_log2: int = BINS_LOG2) -> np.ndarray:
    """One value per bin of a non-empty sorted set."""
    bins = 1 << bins_log2
    own = (members >> np.uint64(64 - bins_log2)).astype(np.int64)
    filled, first = np.unique(own, return_index=True)
    values = np.zeros(bins, np.uint64)
    has = np.zeros(bins, bool)
    values[filled], has[filled] = members[first], True
    if len(filled) < bins:
        draws = _draws(bins)
        empty = np.flatnonzero(~has)
        source = draws[empty, has[draws[empty]].argmax(axis=1)]
        values[empty] = values[source]
    return values


def band_hashes(values: np.ndarray, rows: int) -> np.ndarray:
    table = values[: len(values) // rows * rows].reshape(-1, rows)
    total = np.arange(len(table), dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        total = _mix(total * _BASE + table[:, i])
    return total.view(np.int64)


def _class_of(members: np.ndarray) -> list[int]:
    """128 bits that equal sets share."""
    return np.frombuffer(hashlib.md5(members.tobytes()).digest(), np.int64).tolist()


def _signed(batches: Iterator[pa.RecordBatch], shingle: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, one, two, bands = [], [], [], []
        for text in batch.column(1).to_pylist():
            members = shingle_set(text, shingle)
            sizes.append(len(members))
            if len(members):
                for column, value in zip((one, two), _class_of(members)):
                    column.append(value)
                bands.append(band_hashes(signature(members), rows))
            else:
                one.append(None)
                two.append(None)
                bands.append(None)
        yield pa.record_batch(
            [
                batch.column(2),
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(one, pa.int64()),
                pa.array(two, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "key", "n", "c1", "c2", "bands"],
        )


def _confirmed(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs that reach the similarity; the last set on the hub's side is kept for the next row."""
    known, held = None, None
    for batch in batches:
        left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        good = []
        for a, b in zip(left, right):
            if b != known:
                known, held = b, shingle_set(b, shingle)
            mine = shingle_set(a, shingle)
            small, big = (mine, held) if len(mine) <= len(held) else (held, mine)
            if 100 * len(small) < percent * len(big):
                good.append(False)
                continue
            at = np.searchsorted(big, small)
            at[at == len(big)] = 0
            common = int((big[at] == small).sum())
            good.append(100 * common >= percent * (len(mine) + len(held) - common))
        yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))


def _class_texts(base: DataFrame, wanted: DataFrame, order, shingle: int) -> DataFrame:
    """(c, text): one text for each wanted class."""
    wanted = stored(wanted, "wanted", compact=True)
    ids = wanted.select(F.when(F.col("c.id") != NO_ID, F.col("c.id")).alias("wanted_id")).distinct()
    # a bit set of the wanted ids keeps the other texts out of the shuffle
    bits = stored_bits(ids.select(F.xxhash64("wanted_id").alias("h")))
    near = base.where(might_hold(F.xxhash64("doc_id"), bits))
    found = near.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [_class_of(shingle_set(t, shingle)) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [*batch.columns, *(pa.array([p[i] for p in pairs], pa.int64()) for i in range(2))],
                ["doc_id", "text", "c1", "c2"],
            )

    return stored(
        found.mapInArrow(tidy(digests), "doc_id long, text string, c1 long, c2 long")
        .select(F.struct(order.alias("id"), "c1", "c2").alias("c"), "text")
        .join(wanted, "c", "left_semi")
        .dropDuplicates(["c"]),
        "texts",
    )


def _prefix_pairs(members: DataFrame, whole: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (x, y) of different roots that can still be linked, by rarest shingles.

    Of ``n`` shingles in one fixed order, linked sets share one of their first
    ``n - ceil(n * percent / 100) + 1``. With the rarest first, these are mostly a text's
    own, so a large bucket gives few pairs although none is left out; the place of the
    first common shingle bounds the overlap and drops most of the others.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, shingle).view(np.int64) for t in batch.column(2).to_pylist()]
            at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            for part in np.array_split(np.arange(len(at)), len(at) // 100_000 + 1):
                flat = np.concatenate(sets)[part] if len(part) else np.empty(0, np.int64)
                rows = pa.array(at[part])
                yield pa.record_batch(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(flat)], ["c", "root", "s"]
                )

    kind = T.StructType([*members.select("c", "root").schema.fields, T.StructField("s", T.LongType())])
    tokens = stored(
        members.join(whole, "c").select("c", "root", "text").mapInArrow(tidy(spread), kind), "shingles"
    )
    counts = stored(tokens.groupBy("s").agg(F.count(F.lit(1)).alias("df")), "rarity", compact=True)
    ordered = tokens.join(counts, "s").groupBy("c", "root").agg(
        F.sort_array(F.collect_list(F.struct("df", "s"))).alias("all")
    )
    n = F.size("all")
    first = (n - F.ceil(n * percent / 100) + 1).cast("int")
    prefix = stored(
        ordered.select("c", "root", n.alias("n"), F.posexplode(F.slice("all", F.lit(1), first)))
        .select("c", "root", "n", F.col("pos").alias("i"), F.col("col.s").alias("s")),
        "prefixes",
    )
    across = (
        prefix.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    )
    left = stored(prefix.join(stored(across.select("s"), "across", compact=True), "s"), "prefixes")
    right = left.select(
        "s", F.col("c").alias("y"), F.col("n").alias("ny"), F.col("root").alias("ry"), F.col("i").alias("iy")
    )
    near = 100 * F.least("n", "ny") >= percent * F.greatest("n", "ny")
    # at the first shingle in common, what follows in the shorter rest bounds the overlap
    needed = F.col("n") + F.col("ny")
    enough = (100 + percent) * F.least(F.col("n") - F.col("i"), F.col("ny") - F.col("iy")) >= percent * needed
    pairs = left.join(right, "s").where((F.col("root") < F.col("ry")) & near & enough)
    return pairs.select(F.col("c").alias("x"), "y").distinct()


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: (doc_id, key, n_shingles, component_id, kept, group).

    ``component_id`` is the smallest id reachable by links of at least ``percent``
    hundredths Jaccard similarity, ``kept`` says it is the row's own. ``group`` names the
    component also where ids are null, and is null for a text without words. Ids are
    integers, or text that casts to them.
    """
    base = texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = base.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text", "doc_id")
    kind = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            keyed.schema["key"],
            T.StructField("n", T.LongType()),
            T.StructField("c1", T.LongType()),
            T.StructField("c2", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    signed = stored(keyed.mapInArrow(tidy(lambda b: _signed(b, shingle, rows)), kind), "signed")
    order = F.coalesce("doc_id", F.lit(NO_ID))
    classes = stored(
        signed.where("n > 0")
        .groupBy("c1", "c2")
        .agg(
            F.min(order).alias("id"),
            F.first("n").alias("n"),
            F.first("bands").alias("bands"),
            F.count(F.lit(1)).alias("copies"),
        )
        .select(F.struct("id", "c1", "c2").alias("c"), "n", "bands", "copies"),
        "classes",
    )
    member = classes.select(F.explode("bands").alias("band"), "c", "n")
    size = member.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    size = stored(size.select("band"), "shared")
    # most bands belong to one class: a bit set drops them before the shuffle
    some = member.where(might_hold(F.col("band"), stored_bits(size.select(F.col("band").alias("h")))))
    shared = stored(some.join(size, "band"), "buckets")

    def fits(a: str, b: str):
        return (100 * F.least(a, b) >= percent * F.greatest(a, b))

    def star(open_rows: DataFrame, salt: int) -> DataFrame:
        """Pairs of every member with the bucket's hub: the smallest, then hashed choices."""
        rank = F.xxhash64("c", F.lit(salt)) if salt else F.lit(0).cast("long")
        hub = stored(
            open_rows.groupBy("band").agg(F.min(F.struct(rank.alias("r"), "c", "n", "root")).alias("h")),
            "hubs", compact=True
        )
        return (
            open_rows.join(hub, "band")
            .where((F.col("root") != F.col("h.root")) & fits("n", "h.n"))
            .select(F.col("c").alias("x"), F.col("h.c").alias("y"))
        )

    pair_type = T.StructType([*shared.select(F.col("c").alias("x"), F.col("c").alias("y")).schema.fields])
    whole = _class_texts(base, shared.select("c").distinct(), order, shingle)

    def confirm(pairs: DataFrame) -> DataFrame:
        """Links among the pairs, each confirmed on the two full sets."""
        both = (
            pairs.distinct()
            .join(whole.select(F.col("c").alias("x"), F.col("text").alias("a")), "x")
            .join(whole.select(F.col("c").alias("y"), F.col("text").alias("b")), "y")
            .select("x", "y", "a", "b")
        )
        return stored(both.mapInArrow(tidy(lambda b: _confirmed(b, shingle, percent)), pair_type), "links", compact=True)

    def label(links: DataFrame) -> DataFrame:
        edges = links.select(F.col("x").alias("u"), F.col("y").alias("v"))
        return stored(components(edges).select(F.col("node").alias("c"), "root"), "roots", compact=True)

    def still_open(roots: DataFrame) -> DataFrame:
        """Members of buckets that reach over several components, with the bucket's size."""
        rows = shared.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
        sizes = (
            rows.groupBy("band")
            .agg(
                F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("m")
            )
            .where("low != high")
        )
        return stored(rows.join(stored(sizes.select("band", "m"), "sizes", compact=True), "band"), "open", compact=True)

    links = confirm(star(shared.withColumn("root", F.col("c")), 0))
    roots = label(links)
    again = still_open(roots)
    if not again.isEmpty():
        links = stored(links.unionByName(confirm(star(again, 1))), "links", compact=True)
        roots = label(links)
        again = still_open(roots)
        small = again.where(F.col("m") <= SMALL_BUCKET)
        other = small.select("band", F.col("c").alias("y"), F.col("n").alias("ny"), F.col("root").alias("ry"))
        few = (
            small.join(other, "band")
            .where((F.col("root") < F.col("ry")) & fits("n", "ny"))
            .select(F.col("c").alias("x"), "y")
        )
        members = again.where(F.col("m") > SMALL_BUCKET).select("c", "root").distinct()
        links = stored(
            links.unionByName(confirm(few.unionByName(_prefix_pairs(members, whole, shingle, percent)))),
            "links", compact=True
        )
        roots = label(links)
    special = (
        classes.join(roots, "c", "left")
        .where("copies > 1 OR root IS NOT NULL")
        .select(
            F.col("c.c1").alias("c1"), F.col("c.c2").alias("c2"), F.coalesce("root", "c").alias("root")
        )
    )
    joined = signed.join(stored(special, "components", compact=True), ["c1", "c2"], "left")
    own = F.when(F.col("n") > 0, F.struct(order.alias("id"), "c1", "c2"))
    found = F.when(F.col("root.id") == NO_ID, F.lit(None)).otherwise(F.col("root.id"))
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(found)
    return joined.select(
        "doc_id",
        "key",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.coalesce("root", own).alias("group"),
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with one row left of every group: that of the smallest id.

    Rows without words all stay. Of rows with the same id in one group, and of repeated
    rows, one stays.
    """
    rows = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).where(F.col("group").isNotNull())
    order = F.coalesce("doc_id", F.lit(NO_ID))
    keys = stored(
        rows.groupBy("key").agg(
            F.first("group").alias("group"), F.min(order).alias("id"), F.count(F.lit(1)).alias("times")
        ),
        "keys", compact=True
    )
    firsts = keys.groupBy("group").agg(
        F.min(F.struct("id", "key")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    firsts = stored(firsts.where("n > 1").select("group", "first"), "firsts", compact=True)
    held, dropped = unused(docs, "row_key"), unused(docs, "row_dropped")
    flagged = (
        keys.join(firsts, "group", "left")
        .select("key", "times", (F.col("first.key") != F.col("key")).alias("drop"))
        .where("drop OR times > 1")
        .select(F.col("key").alias(held), F.coalesce("drop", F.lit(False)).alias(dropped))
    )
    flagged = stored(flagged, "flagged", compact=True)
    key = row_key(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.withColumn(held, key)
    # only texts whose key is flagged, and the few that look so, are shuffled
    touched = might_hold(F.col(held)["a"], stored_bits(flagged.select(F.col(held)["a"].alias("h"))))
    left = rows.where(touched).join(flagged, held, "left")
    single = rows.where(~touched).unionByName(left.where(F.col(dropped).isNull()).drop(dropped))
    if not flagged.where(~F.col(dropped)).isEmpty():
        again = left.where(~F.col(dropped)).drop(dropped).dropDuplicates([held])
        single = single.unionByName(again)
    return single.select(docs.columns)
