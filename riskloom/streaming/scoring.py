"""Scoring and drift monitoring over streams.

A stream is scored by the same transform as a batch. The monitor counts each time
window's values per frozen reference bin; a window's PSI is final once the
watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.drift import bin_of, psi_against_profile
from riskloom.plans.shape import tall


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """File stream over a folder; ``files`` narrows it to a name pattern."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score_stream(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    once: bool = True,
) -> StreamingQuery:
    """Append scored rows to a Parquet table, exactly once per input row."""
    writer = (
        stream.transform(score)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def window_counts(
    stream: DataFrame,
    profile: DataFrame,
    features: Sequence[str],
    time: str = "ts",
    window: str = "1 day",
    delay: str = "1 hour",
) -> DataFrame:
    """(window_start, feature, bin, n) of the known values; state is one row per
    window, feature and bin."""
    edges = profile.select("feature", "edges")
    # watermarks need an instant; a zone-less time is read in the session time zone
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    long = tall(timed, features, [time])
    # the profile holds one row per watched feature: the size is that of the schema
    return (
        long.where(F.col("value").isNotNull())
        .join(F.broadcast(edges), "feature")
        .withColumn("bin", F.coalesce(bin_of(F.col("value"), F.col("edges")), F.lit(-1)))
        .groupBy(F.window(time, window).alias("window"), "feature", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), "feature", "bin", "n")
    )


def monitor_stream(counts: DataFrame, output: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the counts of closed windows to a Parquet table."""
    writer = (
        counts.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def window_psi(counts: DataFrame, profile: DataFrame) -> DataFrame:
    """PSI and band per closed window and feature."""
    known = counts.withColumn("bin", F.when(F.col("bin") >= 0, F.col("bin")))
    return psi_against_profile(known, profile, ["window_start"])
