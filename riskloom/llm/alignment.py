"""Alignment of two tokenizers over every text by coalescing byte intervals.

A is a byte-level BPE, B a piece model that puts a space before a text; both cover the bytes
of a space and the text. Neither has a token across the start of a word (a single space
before another character; ``Pair`` checks the pieces of B), so each task cuts its texts
into words and aligns each distinct word once:

* the tokens of A and B of many words are intervals on one line, a word after the other;
* they are sorted by start (``lexsort``), a running maximum of the ends is taken, and a
  group ends where a start reaches it: there an A and a B token end together;
* all A-B pairs inside a group are links.

A text is the list of its words' groups; its distinct id pairs and their numbers of links are kept
packed. The documents that hold a pair are counted in each task first, then by pair. The most
frequent pairs (at most ``head``, cut at a frequency) go back to the texts as a broadcast of
bounded size; all rarer pairs go back through a join by pair, so no hot pair is shuffled.

Texts that are null or empty, or whose tokens' bytes differ from space and text, have no
tokens. Repeated rows count as documents each. Ids may be null or repeat. Further columns are
not read. Words of any length are aligned whole.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm.bpe import frequency_cut
from riskloom.llm.common import stored

HEAD_PAIRS = 1 << 20
WORDS_HELD = 150_000
SLICE_CHARS = 2 << 20
PAIRS_HELD = 1 << 21
HEX_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def byte_of_character() -> dict[str, int]:
    """The characters by which byte-level vocabularies write the 256 bytes."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


BLANK_AFTER_SPACE = re.compile(r" (?:\s|$)|^ ")


def words_of(text: str) -> list[str]:
    """Parts of a text without the space before each; joined by a space they are the text.

    A part starts after a single space that stands before a character that is no white
    space; no token of either side reaches over such a start.
    """
    parts = text.split(" ")
    if not BLANK_AFTER_SPACE.search(text):
        return parts
    out = [parts[0]]
    for before, part in zip(parts, parts[1:]):
        if before and part and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out


def groups_of(stops_a: np.ndarray, stops_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and every B token; both tile the same line from zero on.

    Interval coalescing: sorted by start, a group breaks where a start reaches the largest
    end so far.
    """
    stop = np.concatenate([stops_a, stops_b])
    start = np.concatenate([np.zeros(min(len(stops_a), 1), np.int64), stops_a[:-1], np.zeros(min(len(stops_b), 1), np.int64), stops_b[:-1]])
    side = np.repeat([0, 1], [len(stops_a), len(stops_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(stop[order])
    breaks = np.zeros(len(stop), np.int64)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(stop), np.int64)
    group[order] = np.cumsum(breaks)
    return group[: len(stops_a)], group[len(stops_a) :]


class Pair:
    """Two vocabularies and the aligned words a worker has met; ``WORDS_HELD`` bounds them."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        alphabet = byte_of_character()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocab.values(), default=-1) + 1)
        for piece, number in vocab.items():
            if all(c in alphabet for c in piece):
                self.bytes_a[number] = bytes(alphabet[c] for c in piece)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces that reach over the start of a word cannot be aligned word by word")
        self.bytes_b = [
            bytes([int(m[1], 16)]) if (m := HEX_BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces
        ]
        self.size_b = max(len(pieces), 1)
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.opens_a = np.array([x.startswith(b" ") for x in self.bytes_a])
        self.opens_b = np.array([x.startswith(b" ") for x in self.bytes_b])
        # ids with what follows them in the text of groups
        self.shown = [f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in "|,"]
        self.shown_b = len(self.shown)
        self.shown += [f"{i}{mark}" for i in range(len(pieces)) for mark in (";", ",", "")]
        self.clear()

    def clear(self) -> None:
        """Forget all words."""
        self.number: dict[str, int] = {}
        self.text: list[str] = []
        self.facts = np.empty((0, 5), np.int64)  # whole, n_a, n_b, groups, links
        self.keys = np.empty(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def _is(self, ids_a: list[int], ids_b: list[int], text: str) -> bool:
        raw = text.encode()
        return b"".join([self.bytes_a[k] for k in ids_a]) == raw and b"".join([self.bytes_b[k] for k in ids_b]) == raw

    def _tokens(self, words: list[str]):
        """Words in some order with their A and B ids end to end, numbers of ids, and whether
        their bytes are right. Plain words go through the tokenizers many at once: a token that
        starts with a space starts a word.
        """
        order, whole, flat, sizes = [], [], ([], []), ([], [])
        alone = [w for w in words if not w or " " in w or w[0].isspace()]
        plain = list(set(words).difference(alone))
        for at in range(0, len(plain), 1000):
            some = plain[at : at + 1000]
            text = " ".join(some)
            ids = [self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)]
            starts = [np.flatnonzero(opens[i]) for opens, i in zip((self.opens_a, self.opens_b), ids)]
            if any(len(s) != len(some) for s in starts) or not self._is(*ids, " " + text):
                alone += some
                continue
            order += some
            whole.append(np.ones(len(some), bool))
            for side in (0, 1):
                flat[side].append(np.array(ids[side], np.int64))
                sizes[side].append(np.diff(starts[side], append=len(ids[side])))
        for w in alone:
            ids = [self.a.encode(" " + w, add_special_tokens=False).ids, self.b.encode(w)]
            right = self._is(*ids, " " + w)
            order.append(w)
            whole.append(np.array([right]))
            for side in (0, 1):
                flat[side].append(np.array(ids[side] if right else [], np.int64))
                sizes[side].append(np.array([len(ids[side]) if right else 0]))
        return order, *map(np.concatenate, (*flat, *sizes, whole))

    def _learn(self, words: list[str]) -> None:
        words, flat_a, flat_b, n_a, n_b, whole = self._tokens(words)
        group_a, group_b = groups_of(np.cumsum(self.length_a[flat_a]), np.cumsum(self.length_b[flat_b]))
        word_a = np.repeat(np.arange(len(words)), n_a)
        many = int(group_a[-1]) + 1 if len(group_a) else 0
        in_a, in_b = np.bincount(group_a, minlength=many), np.bincount(group_b, minlength=many)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        of_word = word_a[first_a]
        groups = np.bincount(of_word, minlength=len(words))
        links = np.bincount(of_word, in_a * in_b, minlength=len(words)).astype(np.int64)
        # every A token of a group with every B token
        wide = in_b[group_a]
        at = np.arange(int(wide.sum())) - np.repeat(np.cumsum(wide) - wide, wide) + np.repeat(first_b[group_a], wide)
        self.keys = np.concatenate([self.keys, np.repeat(flat_a, wide) * self.size_b + flat_b[at]])
        facts = np.stack([whole, n_a, n_b, groups, links], axis=1).astype(np.int64)
        self.facts = np.concatenate([self.facts, facts])
        self.first = np.concatenate([[0], np.cumsum(self.facts[:, 4])])
        # "a,a|b;a|b,b": an id is followed by a comma inside its side of a group
        goes_on_a = np.diff(group_a, append=-1) == 0
        goes_on_b = np.diff(group_b, append=-1) == 0
        mark_b = np.where(goes_on_b, 1, 0)
        mark_b[(np.cumsum(n_b) - 1)[n_b > 0]] = 2
        code = np.concatenate([2 * flat_a + goes_on_a, self.shown_b + 3 * flat_b + mark_b])
        side = np.repeat([0, 1], [len(flat_a), len(flat_b)])
        code = code[np.lexsort((side, np.concatenate([group_a, group_b])))]
        shown = [self.shown[c] for c in code.tolist()]
        stop = np.cumsum(n_a + n_b).tolist()
        self.text += ["".join(shown[i:j]) for i, j in zip([0, *stop], stop)]
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words))))

    def aligned(self, some: list[str | None]) -> tuple[np.ndarray, list[str], list[tuple[np.ndarray, np.ndarray]]]:
        """For each text n_a, n_b, n_groups, n_links; its groups as text; its distinct pairs and
        the links of each.
        """
        parts = [words_of(t) if t else [] for t in some]
        if len(self.number) > WORDS_HELD:
            self.clear()
        unseen = set().union(*parts).difference(self.number)
        if unseen:
            self._learn(list(unseen))
        get = self.number.__getitem__
        listed = [list(map(get, p)) for p in parts]
        docs = len(some)
        n = np.array([i for x in listed for i in x], np.int64)
        doc = np.repeat(np.arange(docs), [len(x) for x in listed])
        wrong = np.bincount(doc, 1 - self.facts[n, 0], minlength=docs) > 0
        right = ~wrong[doc]
        n, doc = n[right], doc[right]
        totals = np.zeros((docs, 4), np.int64)
        np.add.at(totals, doc, self.facts[n, 1:])
        size = self.facts[n, 4]
        at = np.arange(int(size.sum())) + np.repeat(self.first[n] - (np.cumsum(size) - size), size)
        bits = max(int(self.size_b * len(self.bytes_a)).bit_length(), 1)
        held = np.sort(np.repeat(doc, size) << bits | self.keys[at])
        edge = np.concatenate([[0], np.flatnonzero(held[1:] != held[:-1]) + 1, [len(held)]]) if len(held) else np.zeros(1, int)
        links, held = np.diff(edge), held[edge[:-1]]
        cuts = np.searchsorted(held >> bits, np.arange(docs + 1))
        held &= (1 << bits) - 1
        shown = ["" if bad else ";".join([self.text[i] for i in x]) for bad, x in zip(wrong.tolist(), listed)]
        return totals, shown, [(held[i:j], links[i:j]) for i, j in zip(cuts, cuts[1:])]


@functools.lru_cache(maxsize=1)
def pair_of(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def pack(keys: np.ndarray, links: np.ndarray, compress) -> bytes:
    """Ascending pairs and their links, as differences."""
    both = np.concatenate([np.diff(keys, prepend=0), links]).astype("<u8")
    return compress(both.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(raw: bytes, decompress) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(decompress(raw), np.uint8).reshape(8, -1).T.copy().view("<u8").ravel().astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


_OWN = [
    ("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()),
]


def _aligned(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, id_kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows of texts, and rows (pair, n) with the documents of a pair counted in this task."""
    pair = pair_of(path_a, path_b)
    compress = zstandard.ZstdCompressor(level=1).compress
    row = TaskContext.get().partitionId() << 40
    met: list[np.ndarray] = []
    waiting = 0

    def counted() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(met), return_counts=True)
        none = [None] * len(keys)
        kinds = [pa.int64(), id_kind, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.int64(), pa.int64()]
        columns = [none] * 8 + [keys, n]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)

    for batch in batches:
        ids, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        at = 0
        while at < len(ids):
            stop, chars = at, 0
            while stop < len(ids) and (stop == at or chars + len(bodies[stop] or "") <= SLICE_CHARS):
                chars += len(bodies[stop] or "")
                stop += 1
            totals, shown, pairs = pair.aligned(bodies[at:stop])
            none = [None] * len(shown)
            columns = [
                list(range(row, row + len(shown))),
                ids[at:stop],
                *totals.T,
                [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in shown],
                [pack(*x, compress) for x in pairs],
                none,
                none,
            ]
            kinds = [pa.int64(), id_kind, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)
            row += len(shown)
            met += [keys for keys, _ in pairs]
            waiting += sum(len(keys) for keys, _ in pairs)
            if waiting >= PAIRS_HELD:
                yield counted()
                met, waiting = [], 0
            at = stop
    if met:
        yield counted()


NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "pair", "n"]


def links(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, pairs), both stored: a row per document with its packed distinct pairs, and
    (pair, n, best): the documents that hold a pair and whether that is the most any pair
    of its A id has. ``pair`` is A id * size of B + B id.
    """
    import sentencepiece

    id_type = docs.schema[id_col].dataType
    size_b = max(sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size(), 1)
    kind = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", id_type),
            *[T.StructField(n, k) for n, k in _OWN],
            T.StructField("groups_sha256", T.StringType()),
            T.StructField("pairs", T.BinaryType()),
            T.StructField("pair", T.LongType()),
            T.StructField("n", T.LongType()),
        ]
    )
    work = functools.partial(_aligned, path_a=path_a, path_b=path_b, id_kind=to_arrow_type(id_type))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = stored(rows.mapInArrow(work, kind), "aligned")
    counts = both.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stored(counts.withColumn("a", F.floor(F.col("pair") / size_b).cast("long")), "pairs")
    # a row for each A id of the vocabulary at most
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    pairs = stored(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    return both.where("pair IS NULL").drop("pair", "n"), pairs


def aligned(
    docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD_PAIRS
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, ``n_best``
    (links whose pair is held by as many documents as any pair of its A id) and
    ``count_sum`` (the documents of the pair, summed over the links).
    """
    rows, pairs = links(docs, path_a, path_b, id_col=id_col, text_col=text_col)
    cut = frequency_cut(pairs, head)
    band = F.floor(F.log2("n") * 8)
    frequent = pairs.where(band >= cut) if cut is not None else pairs.limit(0)
    known = frequent.select("pair", "n", "best").toArrow()
    order = np.argsort(known["pair"].to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(
        tuple(known[c].to_numpy()[order] for c in ("pair", "n", "best"))
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(row, n_best, count_sum) over the frequent pairs, then (row, pair, links) of the others."""
        pair, n, best = shared.value
        decompress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            own = batch.column(0).to_numpy()
            held = [unpack(x, decompress) for x in batch.column(1).to_pylist()]
            keys = np.concatenate([k for k, _ in held])
            many = np.concatenate([m for _, m in held])
            at = np.repeat(np.arange(len(held)), [len(k) for k, _ in held])
            place = np.searchsorted(pair, keys)
            place[place == len(pair)] = 0
            found = pair[place] == keys if len(pair) else np.zeros(len(keys), bool)
            where, links_of = at[found], many[found]
            bests = np.bincount(where, links_of * best[place[found]], minlength=len(held)).astype(np.int64)
            sums = np.zeros(len(held), np.int64)
            np.add.at(sums, where, links_of * n[place[found]])
            rest = ~found
            gap = [None] * int(rest.sum())
            none = [None] * len(held)
            for columns in (
                [own, bests, sums, none, none],
                [own[at[rest]], gap, gap, keys[rest], many[rest]],
            ):
                yield pa.record_batch(
                    [pa.array(c, pa.int64()) for c in columns], ["row", "n_best", "count_sum", "pair", "links"]
                )

    parts = stored(
        rows.select("row", "pairs").mapInArrow(counted, "row long, n_best long, count_sum long, pair long, links long"),
        "counted",
    )
    others = pairs if cut is None else pairs.where(band < cut)
    tail = parts.where("pair IS NOT NULL").select("row", "pair", "links").join(others, "pair")
    sums = (
        parts.where("pair IS NULL")
        .select("row", "n_best", "count_sum")
        .unionByName(
            tail.select(
                "row", F.when(F.col("best"), F.col("links")).otherwise(F.lit(0)).alias("n_best"), (F.col("links") * F.col("n")).alias("count_sum")
            )
        )
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    return rows.drop("pairs").join(sums, "row").drop("row")
