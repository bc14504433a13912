"""Shared-storage helpers: cutting long lineage and keeping intermediate tables.

Everything goes to the folder the cluster names in ``spark.checkpoint.dir`` so a
lost executor never loses the only copy. A session on one machine without that setting
(tests, a laptop) gets a temporary folder that goes with the process; on a cluster the
missing setting is an error, because a machine's own folder is not shared.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.lru_cache(maxsize=1)
def _own_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="riskloom-", ignore_cleanup_errors=True)


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return _own_folder().name
    raise ValueError("set spark.checkpoint.dir to a folder that all machines share")


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, read back from reliable storage with the plan cut off."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, never reused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/riskloom/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as Parquet in the shared folder, read back with sizes the planner knows."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
