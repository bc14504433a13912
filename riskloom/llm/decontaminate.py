"""Benchmark decontamination by word n-grams, in DataFrame functions only.

The hashes of all benchmark n-grams are packed into one fixed-size bit set that every
task gets as a literal (``2**slots_log2`` longs, whatever the benchmark's size). Each
document tests its rolling n-gram hashes against it in one narrow pass; the few windows
that pass are verified word by word in a join with the n-gram table. Texts are never
shuffled and no hit depends on the size of the bit set, only the number of checks does.

Rows with a null or empty text have no words and are clean. A null item text has no
windows; a null item id counts as a hit but not as an item. Repeated rows each keep
their own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import LOWER, UPPER, bit_set, let, might_hold, row_key, stored, stored_bits, unused

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13


def words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; null gives an empty array."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def window_hashes(tokens: Column, length: int) -> Column:
    """Hash of every run of ``length`` tokens, by position; doubling, not re-hashing."""

    def joined(left: Column, right: Column, shift: int) -> Column:
        moved = F.slice(right, F.lit(shift + 1), F.greatest(F.size(right) - shift, F.lit(0)))
        return F.zip_with(left, moved, lambda a, b: F.xxhash64(a, b))

    def grow(power: Column, size: int, bits: str, done: Column | None, covered: int) -> Column:
        if bits[0] == "1":
            done = power if done is None else joined(done, power, covered)
            covered += size
        if len(bits) == 1:
            return done
        if bits[0] == "1":
            return let(done, lambda d: double(power, size, bits, d, covered))
        return double(power, size, bits, done, covered)

    def double(power, size, bits, done, covered):
        return let(
            joined(power, power, size), lambda p: grow(p, 2 * size, bits[1:], done, covered)
        )

    bits = bin(length)[:1:-1]
    every = let(
        F.transform(tokens, lambda w: F.xxhash64(w)),
        lambda p: grow(p, 1, bits, None, 0),
    )
    return F.slice(every, F.lit(1), F.greatest(F.size(tokens) - (length - 1), F.lit(0)))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(h, length, words, items): every distinct window with the ids of its items."""
    tokens = items.select(
        F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("tokens")
    ).where(F.size("tokens") > 0)
    length = F.least(F.size("tokens"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("tokens") - length + 1)
    return (
        tokens.select("item", F.explode(F.transform(
            starts, lambda s: F.slice(F.col("tokens"), s, length))).alias("words"))
        .groupBy("words")
        .agg(F.collect_set("item").alias("items"))
        .select("words", F.size("words").alias("length"), "items")
    )


def scan(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slots_log2: int = 16,
) -> DataFrame:
    """One row per document: (doc_id, key, n_words, n_hit, items).

    ``items`` holds the ids, as sorted strings, of the items with an occurring window;
    ``n_hit`` counts the words inside any occurrence. Items shorter than ``window`` are
    one window of all their words.
    """
    grams = stored(benchmark_windows(items, item_id_col, item_text_col, window), "grams")
    lengths = sorted(r[0] for r in grams.select("length").distinct().collect())
    hashed = None
    for length in lengths:
        part = grams.where(F.col("length") == length)
        part = part.withColumn("h", F.get(window_hashes(F.col("words"), length), 0))
        hashed = part if hashed is None else hashed.unionByName(part)
    key = row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    base = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.col(text_col).alias("t"))
    if hashed is None:
        return base.select(
            "doc_id", "key", F.size(words(F.col("t"))).cast("long").alias("n_words"),
            F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
        )
    present = bit_set(hashed, slots_log2)

    def hits(tokens: Column, length: int) -> Column:
        def test(h, at):
            found = might_hold(h, present, slots_log2)
            return F.when(found, F.struct(at.alias("at"), h.alias("h")))

        marked = F.filter(
            F.transform(window_hashes(tokens, length), test), lambda x: x.isNotNull()
        )
        return F.transform(
            marked,
            lambda x: F.struct(
                x["at"].alias("at"), F.slice(tokens, x["at"] + 1, length).alias("words")
            ),
        )

    def row(tokens: Column) -> Column:
        found = F.concat(*[hits(tokens, n) for n in lengths])
        return F.struct(F.size(tokens).cast("long").alias("n_words"), found.alias("found"))

    marked = stored(
        base.select("doc_id", "key", let(words(F.col("t")), row).alias("r")).select(
            "doc_id", "key", "r.n_words", "r.found"
        ),
        "windows",
    )
    checked = (
        marked.where(F.size("found") > 0)
        .select("key", F.explode("found").alias("f"))
        .select("key", F.col("f.at").alias("at"), F.col("f.words").alias("words"))
        .join(grams.select("words", "length", "items"), "words")
        .groupBy("key")
        .agg(
            F.sort_array(F.collect_set(F.struct("at", "length"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["at"] + s["length"]).alias("end"),
            (
                acc["n"]
                + F.greatest(s["at"] + s["length"] - F.greatest(acc["end"], s["at"]), F.lit(0))
            ).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    verdict = checked.select("key", covered.cast("long").alias("n_hit"), F.sort_array("items").alias("items"))
    return (
        marked.select("doc_id", "key", "n_words")
        .join(verdict, "key", "left")
        .select(
            "doc_id",
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def contaminated(share_of: int = 20) -> Column:
    """Hit at all, and at least one word in ``share_of`` hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share_of >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = scan(docs, items, id_col=id_col, text_col=text_col, **options).where(contaminated())
    key = row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    held = unused(docs, "row_key")
    bad = stored(bad.select(F.col("key").alias(held)).distinct(), "contaminated")
    rows = docs.withColumn(held, key)
    # only texts whose key is listed, and the few that look so, are shuffled
    touched = might_hold(F.col(held)["a"], stored_bits(bad.select(F.col(held)["a"].alias("h"))))
    left = rows.where(touched).join(bad, held, "left_anti")
    return rows.where(~touched).unionByName(left).select(docs.columns)
