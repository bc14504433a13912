"""BPE encoding and decoding through a table of distinct words.

Texts are split at white space. Words that occur twice or more in some task are counted over
the corpus, encoded once, and the most frequent of them (at most ``head``, cut at a frequency so that ties
fall out together) go to the tasks as a broadcast of bounded size, so no hot word is ever
shuffled. All other words are shuffled by word with their places, encoded once each in sorted order, and
go back to their documents by position. Between the two, a document is a short column of
word numbers, not its text; both meet by the document's key.

A word outside the head occurs once in a task at most, or is rarer than all of the head.

Splitting first is exact for a tokenizer whose normaliser and pre-tokenizer never join
characters across white space and drop the white space itself.

Decoding looks every id up in the vocabulary, a literal array in the row (``decoded``).

A null text is an empty one: no ids, an empty decoded text. Rows may repeat or lack an
id; each row keeps its own result.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm.common import give_back, in_slices, stored, texts, tidy

HEAD_WORDS = 200_000
WORDS_HELD = 250_000
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
CONTROLS = "\x1c\x1d\x1e\x1f"  # str.split() takes these for space as well


def loaded(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    return loaded(path)


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _table(*values: int) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


CLOSES = _table(*b".,!?;:")
BEFORE_CLOSING = _table(*b"0123456789abcdefghijklmnopqrstuvwxyz")
# second bytes of the small Latin-1 letters from \xdf on, all but \xf7
LATIN_BYTE = _table(*range(0x9F, 0xB7), *range(0xB8, 0xC0))


def _apart(ready: pa.StringArray, plain: list[bool]) -> pa.StringArray:
    """A space between a small Latin-1 letter or a digit and closing punctuation after it, in
    the ``plain`` texts. One may also come at an end of a text, where it changes no word."""
    _, offsets, data = ready.buffers()
    if data is None or not data.size:
        return ready
    bounds = np.frombuffer(offsets, np.int32, len(ready) + 1)
    raw = np.frombuffer(data, np.uint8, int(bounds[-1]))
    at = np.flatnonzero(CLOSES[raw[1:]]) + 1
    before = raw[at - 1]
    at = at[BEFORE_CLOSING[before] | LATIN_BYTE[before] & (raw[at - 2] == 0xC3)]
    if not all(plain):
        at = at[np.array(plain)[np.searchsorted(bounds, at, "right") - 1]]
    moved = (bounds + np.searchsorted(at, bounds)).astype(np.int32)
    # built by the library itself: its readers look past the end of a buffer of others
    data = pa.array([np.insert(raw, at, 32).tobytes()], pa.binary()).buffers()[2]
    return pa.Array.from_buffers(pa.string(), len(ready), [None, pa.py_buffer(moved), data])


def cut(some: list[str]) -> pa.ListArray:
    """Parts of each text whose ids, one after the other, are the ids of the text.

    Any text may be cut at white space. A text of Latin-1 characters without special
    tokens is lower-cased, as the tokenizer does next, and closing punctuation leaves the
    letter or digit before it, where the tokenizer parts them anyway.
    """
    plain = ["<|" not in t and is_latin(t) for t in some]
    ready = _apart(pa.array([t.lower() if p else t for t, p in zip(some, plain)], pa.string()), plain)
    split = pc.utf8_split_whitespace(ready)
    words = split.flatten()
    filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(filled)])[split.offsets.to_numpy()]
    lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), words.filter(pa.array(filled)))
    # these four are space for the library of arrays, not for the tokenizer; a text has the
    # same parts whatever texts come with it
    odd = {i for i, t in enumerate(some) if any(c in t for c in CONTROLS)}
    if odd:
        parts = lists.to_pylist()
        for i in odd:
            parts[i] = [w for w in SPACE.split(ready[i].as_py()) if w]
        return pa.array(parts, pa.list_(pa.string()))
    return lists


@tidy
def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) for the words met twice or more; at most ``WORDS_HELD`` and those of a slice
    are held at a time."""
    held: dict[str, int] = {}

    def flush() -> pa.RecordBatch:
        often = [w for w, n in held.items() if n > 1]
        out = pa.record_batch([pa.array(often, pa.string()), pa.array([held[w] for w in often], pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in in_slices(batches):
        coded = cut(batch.column(0).to_pylist()).flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        counts = np.bincount(coded.indices.to_numpy(), minlength=len(words)).tolist()
        for word, n in zip(words, counts):
            held[word] = held.get(word, 0) + n
        if len(held) >= WORDS_HELD:
            yield flush()
    if held:
        yield flush()


@functools.lru_cache(maxsize=2)
def ends_of_words(path: str) -> np.ndarray:
    """Which ids are pieces that end a word."""
    vocab = tokenizer(path).get_vocab(with_added_tokens=True)
    ends = np.zeros(max(vocab.values(), default=-1) + 1, bool)
    for piece, number in vocab.items():
        ends[number] = piece.endswith("</w>")
    return ends


def encode_words(path: str, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct ``words`` in some order, their numbers of ids, and the ids end to end.

    Words of Latin-1 letters go through the tokenizer 500 at once: each is one word to it, so
    the ids that end a word part them. All others, and any 500 that come back in another
    number of words, go one by one.
    """
    tok, ends = tokenizer(path), ends_of_words(path)
    order: list[str] = []
    lengths, flat = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
    others = [w for w in words if not (w.isalpha() and is_latin(w))]
    plain = list(set(words).difference(others))
    for at in range(0, len(plain), 500):
        some = plain[at : at + 500]
        # the fast form leaves out the places of the ids in the text
        ids = np.array(tok.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
        stops = np.flatnonzero(ends[ids]) + 1
        if len(stops) == len(some) and stops[-1] == len(ids):
            order += some
            flat.append(ids)
            lengths.append(np.diff(stops, prepend=0))
        else:
            others += some
    done = [e.ids for e in tok.encode_batch_fast(others, add_special_tokens=False)]
    lengths.append(np.fromiter(map(len, done), np.int64, len(done)))
    flat.append(np.array([i for ids in done for i in ids], np.uint32))
    return order + others, np.concatenate(lengths), np.concatenate(flat)


def packed_ids(path: str, words: list[str]) -> list[bytes]:
    """The ids of each of the distinct words as little-endian unsigned 32-bit integers."""
    order, lengths, flat = encode_words(path, words)
    raw, stop = flat.astype("<u4").tobytes(), (4 * np.cumsum(lengths)).tolist()
    ids = {w: raw[a:b] for w, a, b in zip(order, [0, *stop], stop)}
    return [ids[w] for w in words]


def word_table(rows: DataFrame, path: str, head: int) -> pa.Table:
    """(word, n, ids) of at most ``head`` words of ``rows.text``, by falling frequency."""

    @F.pandas_udf("binary")
    def encoded(words):
        import pandas as pd

        return pd.Series(packed_ids(path, list(words)), dtype=object)

    counted = rows.select("text").mapInArrow(_repeated, "word string, n long")
    table = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    cut = frequency_cut(table, head)
    frequent = table.where(F.floor(F.log2("n") * 8) >= cut) if cut is not None else table.limit(0)
    # bounded by ``head``
    return frequent.withColumn("ids", encoded("word")).orderBy(F.desc("n"), "word").toArrow()


@functools.lru_cache(maxsize=2)
def joined_pieces(path: str) -> str:
    """The vocabulary in the order of its ids; the tokenizer itself does not stay on the driver."""
    vocab = loaded(path).get_vocab(with_added_tokens=True)
    pieces = [""] * (max(vocab.values(), default=-1) + 1)
    for piece, number in vocab.items():
        pieces[number] = piece
    return "\0".join(pieces)


def decoded(ids: Column, path: str) -> Column:
    """The pieces of an id array joined by a space, as a tokenizer without decoder does.

    The join of ids with pieces is a lookup in the vocabulary, which every task gets as
    one literal array; the vocabulary file bounds its size.
    """
    table = F.split(F.lit(joined_pieces(path)), "\0")
    return F.array_join(F.transform(ids, lambda i: F.get(table, i)), " ")


def frequency_cut(table: DataFrame, head: int) -> int | None:
    """The lowest band of 8 * log2(count) above which at most ``head`` words lie."""
    band = F.floor(F.log2("n") * 8)
    left, cut = head, None
    counts = table.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("words")).collect()
    for row in sorted(counts, key=lambda r: -r.band):
        left -= row.words
        if left < 0:
            break
        cut = row.band
    return cut


class Head:
    """The frequent words in a task: numbers by falling frequency, and ids laid end to end."""

    def __init__(self, packed: bytes):
        rows = pa.ipc.open_stream(packed).read_all().combine_chunks()
        self.words = rows["word"]
        self.size = len(rows)
        ids = rows["ids"].to_pylist()
        lengths = np.fromiter(map(len, ids), np.int64, self.size) // 4
        self.flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        self.length = np.concatenate([lengths, [0]])
        self.start = np.concatenate([np.cumsum(lengths) - lengths, [0]])

    @functools.cached_property
    def number(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self.words.to_pylist())}

    def numbered(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
        """The numbers of the words of the texts (``size`` for any other word), the bounds of
        the texts in them, and the words."""
        lists = cut(some)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        own = np.fromiter((self.number.get(w, self.size) for w in words), np.int64, len(words))
        return own[coded.indices.to_numpy()], lists.offsets.to_numpy(), coded


DIRECT = 128


def pack_numbers(n: np.ndarray) -> bytes:
    """Word numbers in three parts: a byte each, then 12 bits more for those over ``DIRECT``."""
    rest = n[n >= DIRECT] - DIRECT
    first = n.astype(np.uint8)
    first[n >= DIRECT] = DIRECT + (rest >> 12)
    return np.uint32(len(n)).tobytes() + first.tobytes() + (rest & 255).astype(np.uint8).tobytes() + (rest >> 8 & 15).astype(np.uint8).tobytes()


def unpack_numbers(raw: bytes) -> np.ndarray:
    size = int(np.frombuffer(raw, np.uint32, 1)[0])
    first = np.frombuffer(raw, np.uint8, size, 4).astype(np.int64)
    more = first >= DIRECT
    k = int(more.sum())
    low = np.frombuffer(raw, np.uint8, k, 4 + size).astype(np.int64)
    high = np.frombuffer(raw, np.uint8, k, 4 + size + k).astype(np.int64)
    first[more] = DIRECT + ((first[more] - DIRECT) << 12) + (high << 8) + low
    return first


def laid_out(numbers: np.ndarray, known: Head, tail: dict[int, bytes]) -> np.ndarray:
    """The ids of a document: frequent words by number, the others from ``tail`` by position."""
    lengths = known.length[numbers]
    if len(tail) != int((numbers == known.size).sum()):
        raise ValueError("a word without ids")
    for at, ids in tail.items():
        lengths[at] = len(ids) // 4
    stop = np.cumsum(lengths)
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.int32)
    own = np.flatnonzero(numbers < known.size)
    size = lengths[own]
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(stop[own] - size, size) + within] = known.flat[np.repeat(known.start[numbers[own]], size) + within]
    for at, ids in tail.items():
        out[stop[at] - len(ids) // 4 : stop[at]] = np.frombuffer(ids, "<u4")
    return out


def example_bodies(counts: np.ndarray, many: int = 1500, words: int = 500) -> list[bytes]:
    """Bodies of made-up documents with the words' frequencies, to prepare the compressor."""
    share = counts / max(counts.sum(), 1)
    draws = np.random.default_rng(7).choice(len(counts), (many, words), p=share) if len(counts) else []
    return [pack_numbers(d) for d in draws]


def encode(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    head: int = HEAD_WORDS,
) -> DataFrame:
    """One row per document: (doc_id, ids array<int>); see ``decoded`` for the way back."""
    if head > (256 - DIRECT) << 12:
        raise ValueError("head holds too many words")
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    keyed = rows.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("a"),
        F.hash("text", "doc_id").alias("b"),
        "text",
    )
    arrow = word_table(rows, path, head)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, arrow.schema) as writer:
        writer.write_table(arrow)
    shared = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
    examples = example_bodies(np.asarray(arrow["n"].to_pylist(), float))
    trained = zstandard.train_dictionary(1 << 15, examples).as_bytes() if len(arrow) > 1000 else b""
    del arrow, sink, writer, examples
    give_back()

    @tidy
    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Head(shared.value)
        for batch in in_slices(batches):
            numbers, bounds, coded = known.numbered(batch.column(2).to_pylist())
            at = np.flatnonzero(numbers == known.size)
            row = np.searchsorted(bounds, at, "right") - 1
            own = pa.array(row)
            words = coded.dictionary.take(coded.indices.take(pa.array(at)))
            pos = pa.array((at - bounds[row]).astype(np.int32))
            yield pa.record_batch(
                [batch.column(0).take(own), batch.column(1).take(own), pos, words], ["a", "b", "pos", "word"]
            )

    @tidy
    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by word: the ids in place of the word."""
        last, last_ids = None, b""
        for batch in batches:
            coded = batch.column(3).dictionary_encode()
            words = coded.dictionary.to_pylist()
            known = words[:1] == [last]
            ids = [last_ids] * known + packed_ids(path, words[1:] if known else words)
            last, last_ids = words[-1] if words else last, ids[-1] if ids else last_ids
            data = pa.array(ids, pa.binary()).take(coded.indices)
            yield pa.record_batch([*batch.columns[:3], data], ["a", "b", "pos", "data"])

    @tidy
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(trained)).compress
        known = Head(shared.value)
        for batch in in_slices(batches):
            numbers, bounds, _ = known.numbered(batch.column(3).to_pylist())
            bodies = [pack(pack_numbers(numbers[low:high])) for low, high in zip(bounds[:-1], bounds[1:])]
            whole = pa.array(np.full(batch.num_rows, -1, np.int32))
            yield pa.record_batch(
                [*batch.columns[:3], whole, pa.array(bodies, pa.binary())], ["doc_id", "a", "b", "pos", "data"]
            )

    @tidy
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by key and position: the bodies of a key, then its rare words."""
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(trained)).decompress
        known = Head(shared.value)
        key, bodies, tail, out = None, [], {}, []

        def finish() -> None:
            for doc_id, body in bodies:
                out.append((doc_id, laid_out(unpack_numbers(unpack(body)), known, tail)))

        def written() -> pa.RecordBatch:
            sizes = np.cumsum([0, *(len(ids) for _, ids in out)]).astype(np.int32)
            flat = np.concatenate([ids for _, ids in out])
            rows = pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat, pa.int32()))
            return pa.record_batch([pa.array([d for d, _ in out], id_arrow), rows], ["doc_id", "ids"])

        for batch in batches:
            for doc_id, a, b, pos, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) != key:
                    finish()
                    key, bodies, tail = (a, b), [], {}
                if pos < 0:
                    bodies.append((doc_id, data))
                else:
                    tail[pos] = data
            if out:
                yield written()
                out.clear()
        finish()
        if out:
            yield written()

    id_type = docs.schema[id_col].dataType
    id_arrow = to_arrow_type(id_type)
    body_type = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("a", T.LongType()),
            T.StructField("b", T.IntegerType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("data", T.BinaryType()),
        ]
    )
    out_type = T.StructType(
        [T.StructField("doc_id", id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )
    tails = (
        keyed.select("a", "b", "text")
        .mapInArrow(rare, "a long, b int, pos int, word string")
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(spelled, "a long, b int, pos int, data binary")
        .select(F.lit(None).cast(id_type).alias("doc_id"), "a", "b", "pos", "data")
    )
    return (
        keyed.mapInArrow(numbered, body_type)
        .unionByName(tails)
        .repartition("a", "b")
        .sortWithinPartitions("a", "b", "pos")
        .mapInArrow(placed, out_type)
    )


def _dictionary(trained: bytes):
    return zstandard.ZstdCompressionDict(trained) if trained else None
