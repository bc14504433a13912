"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.lineage import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), with an empty text for null; other columns cannot clash."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def row_key(doc_id: Column, text: Column) -> Column:
    """A non-null 96-bit key; only rows with equal id and text share one."""
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.hash(text, doc_id).alias("b"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` bears it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def stored(df: DataFrame, purpose: str, compact: bool = False) -> DataFrame:
    """The rows written to the shared folder and read back: survives lost executors.

    ``compact`` writes at most two files for each core, for tables written in loops.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    written = df.coalesce(2 * spark.sparkContext.defaultParallelism) if compact else df
    written.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def _slot(h: Column, slots_log2: int) -> Column:
    return F.shiftrightunsigned(h, 64 - slots_log2).cast("int")


def _bit(h: Column) -> Column:
    return h.bitwiseAND(F.lit(63)).cast("int")


def bit_set(hashes: DataFrame, slots_log2: int = 16) -> Column:
    """A literal array of ``2**slots_log2`` longs with one bit set per hash ``h``.

    Its size is fixed whatever the number of hashes; more hashes only let more others pass.
    """
    rows = (
        hashes.select(_slot(F.col("h"), slots_log2).alias("slot"), _bit(F.col("h")).alias("bit"))
        .groupBy("slot")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .collect()
    )
    packed = ["0"] * (1 << slots_log2)
    for row in rows:
        packed[row.slot] = str(row.bits)
    return F.split(F.lit(",".join(packed)), ",").cast("array<bigint>")


def stored_bits(hashes: DataFrame, slots_log2: int = 16) -> Column:
    """The bits of ``bit_set`` as a scalar subquery over one stored row.

    Neither Python nor the text of a plan holds them, and tasks get them as plain bytes. Not
    for use inside lambdas, where Spark takes no subquery.
    """
    spark = hashes.sparkSession
    bits = (
        hashes.select(_slot(F.col("h"), slots_log2).alias("slot"), _bit(F.col("h")).alias("bit"))
        .groupBy("slot")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    every = spark.range(1 << slots_log2).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("long").alias("bits"))
    # a row per slot: bounded by the size of the set
    full = bits.where("slot IS NOT NULL").unionByName(every).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    row = full.agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", "bits"))), lambda x: x["bits"]).alias("bits"))
    return stored(row, "bits").scalar()


def give_back() -> None:
    """Free memory of this process goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def might_hold(h: Column, bits: Column, slots_log2: int = 16) -> Column:
    """False only for hashes that are not in the bit set."""
    return F.getbit(F.get(bits, _slot(h, slots_log2)), _bit(h)) == 1


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` over batches; at its end the worker, which later tasks use again, gives its
    free memory back to the system.
    """

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so few texts are Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
