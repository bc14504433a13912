"""Independent Spark jobs side by side, started from one driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

R = TypeVar("R")


def concurrently(spark: SparkSession, tasks: Sequence[Callable[[], R]], parallel: int) -> list[R]:
    """Results of the tasks in the order given, at most ``parallel`` of them at a time.

    Each task's jobs go to a scheduler pool of their own, so that with
    ``spark.scheduler.mode=FAIR`` a long task does not hold back the others. The first
    failure in that order is raised after the tasks already started have ended; those not
    yet started are given up.
    """

    def pooled(number: int, task: Callable[[], R]) -> Callable[[], R]:
        def run() -> R:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"side-{number % parallel}")
            return task()

        return inheritable_thread_target(spark)(run)

    if parallel <= 1:
        return [task() for task in tasks]
    with ThreadPoolExecutor(parallel) as pool:
        started = [pool.submit(pooled(i, task)) for i, task in enumerate(tasks)]
        try:
            return [future.result() for future in started]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise
