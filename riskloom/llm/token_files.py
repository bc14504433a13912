"""Token-id files in document order, compressed by a Re-Pair grammar per shard.

Rows are range-partitioned and sorted by id (null first; rows of one id by the hash of their text,
then as read). A task reads its part as a stream, encodes the texts, ends each document with ``end_id`` and
closes a shard whenever ``shard_ids`` ids are held. In a shard the most frequent pairs of
neighbouring ids become nonterminals, round after round, until no pair is frequent. A shard's
file holds

    magic, width, first nonterminal, counts | rules (left, right) | expansion lengths | sequence

so that ids ``lo`` to ``hi`` are found by the running expansion lengths and only the symbols
there are expanded (``ids_between``). The files are rows of a Parquet table: part, seq, the ids
of the part before the file, its own number of ids, the documents' ids and lengths, and the
bytes of the file. Positions in the whole collection come from the totals of parts.

A null text is an empty one: its document holds the end id alone. Repeated rows are repeated
documents. An empty table gives no files. Long texts make their shard longer; nothing is cut.
Further columns are not read.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm.bpe import cut, encode_words, ends_of_words
from riskloom.llm.common import texts

MAGIC = b"RPG1"
HEADER = struct.Struct("<4sBIIIQ")
END_ID = 1
SHARD_IDS = 1 << 20
LEAST = 4
ROUNDS = 5
FALL = 128
WORDS_HELD = 1_000_000
SLICE_CHARS = 8 << 20


# --- the grammar of a shard ---------------------------------------------------------


def grammar(ids: np.ndarray, first: int, least: int = LEAST, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, lengths, sequence): ``rules[k]`` are the two symbols of nonterminal ``first + k``.

    A round replaces the pairs that occur at least a ``FALL``-th as often as the most frequent one,
    frequent pairs before rarer ones where two overlap; a rule is kept if it replaces
    ``least`` occurrences. ``rounds`` bounds the depth of a nonterminal.
    """
    seq = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    n_rules = 0
    lengths = np.empty(0, np.int64)
    keys, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    for _ in range(rounds):
        if len(seq) < 2:
            break
        # symbols of 16 bits make pairs of 32, which sort and spread faster
        kind, half = (np.uint32, 16) if int(seq.max()) < 1 << 16 else (np.uint64, 32)
        pair = seq[:-1].astype(kind) << kind(half) | seq[1:]
        ordered = np.sort(pair)
        at = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])
        count = np.diff(at)
        floor = max(least, int(count.max()) // FALL)
        often = np.flatnonzero(count >= floor)
        if not len(often):
            break
        often = often[np.argsort(-count[often], kind="stable")]
        wanted = ordered[at[often]]
        rank = _ranks(pair, wanted)
        none = len(wanted)
        # a place wins over its neighbours by rank, the left one if equal
        wins = rank < none
        wins[:-1] &= rank[:-1] <= rank[1:]
        wins[1:] &= rank[1:] < rank[:-1]
        place = np.flatnonzero(wins)
        used = np.bincount(rank[place], minlength=none) >= least
        place = place[used[rank[place]]]
        if not len(place):
            break
        # a pair that has a rule already keeps it
        left, right = (wanted >> kind(half)).astype(np.uint64), (wanted & kind((1 << half) - 1)).astype(np.uint64)
        wanted = left << np.uint64(32) | right
        known = np.searchsorted(keys, wanted)
        old = used & (np.append(keys, 0)[known] == wanted)
        fresh = used & ~old
        number = np.cumsum(fresh) - 1 + n_rules
        number[old] = owner[known[old]]
        new = np.stack([left[fresh], right[fresh]], axis=1).astype(np.uint32)
        sizes = np.where(new < first, 1, 0).astype(np.int64)
        deep = new >= first
        sizes[deep] = lengths[new[deep] - first]
        seq[place] = number[rank[place]] + first
        keep = np.ones(len(seq), bool)
        keep[place + 1] = False
        seq = seq[keep]
        rules.append(new)
        lengths = np.concatenate([lengths, sizes.sum(axis=1)])
        keys, owner = np.append(keys, wanted[fresh]), np.append(owner, np.arange(n_rules, n_rules + len(new)))
        by_key = np.argsort(keys)
        keys, owner = keys[by_key], owner[by_key]
        n_rules += len(new)
    table = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    return table, lengths, seq


def _ranks(pair: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each pair stands in ``wanted``, ``len(wanted)`` if nowhere.

    A hash table with one place a slot; of pairs that share a slot the first one stays.
    """
    bits = max(10, len(wanted).bit_length() + 3)
    kind = pair.dtype.type
    spread = kind(0x9E3779B1 if kind is np.uint32 else 0x9E3779B97F4A7C15)
    shift = kind(8 * pair.itemsize - bits)
    slot = (wanted * spread) >> shift
    table = np.full(1 << bits, len(wanted), np.int32)
    table[slot[::-1]] = np.arange(len(wanted), dtype=np.int32)[::-1]
    held = np.append(wanted, kind(0))[table]
    mine = ((pair * spread) >> shift).astype(np.intp)
    out = table.take(mine)
    out[held.take(mine) != pair] = len(wanted)
    return out


def expanded(seq: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids of a sequence of symbols.

    A short sequence takes one pass for each level of the grammar; for a long one the rules
    are expanded that way and the symbols looked up.
    """
    if len(rules) and len(seq) > 4 * len(rules):
        flat = np.concatenate([np.arange(first, dtype=np.uint32), expanded(rules.reshape(-1), rules, first)])
        length = np.ones(first + len(rules), np.int64)
        while True:
            longer = length[rules].sum(axis=1)
            if (longer == length[first:]).all():
                break
            length[first:] = longer
        return gathered(flat, length, seq)[0].astype(np.uint32, copy=False)
    out = seq
    while True:
        deep = out >= first
        if not deep.any():
            return out.astype(np.uint32)
        at = np.arange(len(out)) + np.cumsum(deep) - deep
        longer = np.empty(len(out) + int(deep.sum()), np.uint32)
        longer[at] = out
        both = rules[out[deep] - first]
        longer[at[deep]] = both[:, 0]
        longer[at[deep] + 1] = both[:, 1]
        out = longer


def gathered(flat: np.ndarray, length: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` with these numbers end to end, and where each one ends; run after
    run ``flat`` holds ``length`` entries."""
    each = length[numbers]
    size = int(each.sum())
    kind = np.int32 if max(size, len(flat)) < 1 << 31 else np.int64
    start, each = (np.cumsum(length) - length).astype(kind), each.astype(kind, copy=False)
    stop = np.cumsum(each, dtype=kind)
    place = np.repeat(start[numbers] - (stop - each), each)
    place += np.arange(size, dtype=kind)
    return flat.take(place), stop


def packed(ids: np.ndarray, first: int) -> bytes:
    """The file of a shard."""
    rules, lengths, seq = grammar(ids, first)
    kind = np.dtype("<u2") if first + len(rules) <= 1 << 16 else np.dtype("<u4")
    head = HEADER.pack(MAGIC, kind.itemsize, first, len(rules), len(seq), len(ids))
    return head + rules.astype(kind).tobytes() + lengths.astype("<u4").tobytes() + seq.astype(kind).tobytes()


def unpacked(raw: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(first nonterminal, rules, lengths, sequence) of a file."""
    magic, width, first, n_rules, n_seq, _ = HEADER.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEADER.size
    rules = np.frombuffer(raw, f"<u{width}", 2 * n_rules, at).reshape(-1, 2)
    at += rules.nbytes
    lengths = np.frombuffer(raw, "<u4", n_rules, at)
    seq = np.frombuffer(raw, f"<u{width}", n_seq, at + lengths.nbytes)
    return first, rules.astype(np.uint32), lengths.astype(np.int64), seq.astype(np.uint32)


def ids_between(raw: bytes, low: int, high: int) -> np.ndarray:
    """The ids ``low`` to ``high`` (exclusive) of a file; only the symbols there are expanded."""
    first, rules, lengths, seq = unpacked(raw)
    size = np.ones(len(seq), np.int64)
    deep = seq >= first
    size[deep] = lengths[seq[deep] - first]
    stop = np.cumsum(size)
    low, high = max(low, 0), min(high, int(stop[-1]) if len(stop) else 0)
    if low >= high:
        return np.empty(0, np.uint32)
    a, b = np.searchsorted(stop, low, "right"), np.searchsorted(stop, high, "left")
    start = int(stop[a] - size[a])
    return expanded(seq[a : b + 1], rules, first)[low - start : high - start]


# --- encoding -------------------------------------------------------------------------


class WordIds:
    """Ids of the parts of texts, each kept once in a worker; ``WORDS_HELD`` bounds them."""

    def __init__(self, path: str, end_id: int):
        self.path = path
        self.first = max(len(ends_of_words(path)), end_id + 1)
        self.end_id = end_id
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = [np.array([self.end_id], np.uint32)]
        self.length = [np.array([1], np.int64)]

    def _learn(self, words: list[str]) -> None:
        order, lengths, flat = encode_words(self.path, words)
        self.length.append(lengths)
        self.flat.append(flat)
        start = len(self.number) + 1
        self.number.update(zip(order, range(start, start + len(words))))

    def encoded(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other with their end ids, and their lengths."""
        lists = cut(some)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.number) > WORDS_HELD:
            self.clear()
        unseen = [w for w in words if w not in self.number]
        if unseen:
            self._learn(unseen)
        flat, length = np.concatenate(self.flat), np.concatenate(self.length)
        self.flat, self.length = [flat], [length]
        own = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        size = lists.value_lengths().to_numpy()
        n = np.zeros(len(coded) + len(size), np.int32)  # number 0, the end id, closes every text
        n[np.arange(len(coded)) + np.repeat(np.arange(len(size)), size)] = own[coded.indices.to_numpy()]
        ids, stop = gathered(flat, length, n)
        return ids, np.diff(stop[np.cumsum(size + 1) - 1], prepend=0).astype(np.int64)


@functools.lru_cache(maxsize=1)
def word_ids(path: str, end_id: int) -> WordIds:
    return WordIds(path, end_id)


# --- files ----------------------------------------------------------------------------


def _file_type(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("seq", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("data", T.BinaryType()),
        ]
    )


def _written(batches: Iterator[pa.RecordBatch], path: str, end_id: int, shard_ids: int, id_kind: pa.DataType):
    part, seq = TaskContext.get().partitionId(), 0
    words = word_ids(path, end_id)
    names: list = []
    lengths: list[np.ndarray] = []
    ids: list[np.ndarray] = []
    before, held = 0, 0

    def closed() -> pa.RecordBatch:
        sizes = np.concatenate(lengths)
        columns = [[part], [seq], [before], [held], [names], [sizes], [packed(np.concatenate(ids), words.first)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(id_kind), pa.list_(pa.int64()), pa.binary()]
        return pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "seq", "before", "n_ids", "ids", "lengths", "data"]
        )

    for batch in batches:
        own, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(own):
            stop, chars = at, 0
            while stop < len(own) and (stop == at or chars + len(bodies[stop]) <= SLICE_CHARS):
                chars += len(bodies[stop])
                stop += 1
            flat, sizes = words.encoded(bodies[at:stop])
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            done = 0
            while done < len(sizes):
                # as many documents as fill the shard
                room = np.searchsorted(bounds, bounds[done] + shard_ids - held, "left")
                upto = int(min(max(room, done + 1), len(sizes)))
                names += own[at + done : at + upto]
                lengths.append(sizes[done:upto])
                ids.append(flat[bounds[done] : bounds[upto]])
                held += int(bounds[upto] - bounds[done])
                done = upto
                if held >= shard_ids:
                    yield closed()
                    before += held
                    names, lengths, ids, held, seq = [], [], [], 0, seq + 1
            at = stop
    if names:
        yield closed()


def write(
    docs: DataFrame,
    target: str,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Write the token files of ``docs`` to ``target`` with the vocabulary at ``path``; the
    table of files is returned.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("r"))
    kind = _file_type(docs.schema[id_col].dataType)
    work = functools.partial(
        _written, path=path, end_id=end_id, shard_ids=shard_ids, id_kind=to_arrow_type(docs.schema[id_col].dataType)
    )
    order = ["doc_id", "h", "r"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    sorted_rows.mapInArrow(work, kind).write.parquet(target)
    return spark.read.schema(kind).parquet(target)


def placed(files: DataFrame) -> DataFrame:
    """The files with ``base``: the number of ids in all files before."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each task of the writing job, which bounds what is broadcast
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return files.join(F.broadcast(parts), "part").withColumn("base", F.col("start") + F.col("before")).drop("start")


def documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the files with its place in the
    whole collection; ids are little-endian unsigned 32-bit integers.
    """
    id_type = files.schema["ids"].dataType.elementType
    id_kind = to_arrow_type(id_type)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, lengths, data, base in zip(*(c.to_pylist() for c in batch.columns)):
                first, rules, _, seq = unpacked(data)
                flat = expanded(seq, rules, first).astype("<u4").tobytes()
                stop = np.cumsum(lengths, dtype=np.int64)
                start = stop - np.array(lengths, np.int64)
                for low in range(0, len(ids), 1000):
                    some = slice(low, low + 1000)
                    bodies = [flat[4 * a : 4 * b] for a, b in zip(start[some].tolist(), stop[some].tolist())]
                    yield pa.record_batch(
                        [
                            pa.array(ids[some], id_kind),
                            pa.array(start[some] + base),
                            pa.array(np.array(lengths[some], np.int64)),
                            pa.array(bodies, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    kind = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return placed(files).select("ids", "lengths", "data", "base").mapInArrow(opened, kind)


def between(files: DataFrame, low: int, high: int) -> DataFrame:
    """(start, ids): ids ``low`` to ``high`` of the whole collection, a row for each file they
    touch; only the symbols there are expanded.
    """

    @F.udf("binary")
    def cut(data, base):
        return ids_between(data, low - base, high - base).astype("<u4").tobytes()

    touched = placed(files).where((F.col("base") < high) & (F.col("base") + F.col("n_ids") > low))
    return touched.select(F.greatest("base", F.lit(low)).alias("start"), cut("data", "base").alias("ids"))


def open_files(spark: SparkSession, target: str) -> DataFrame:
    """The table of files written to ``target``."""
    return spark.read.parquet(target)
