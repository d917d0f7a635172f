"""Independent Spark actions submitted together."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_concurrently(spark: SparkSession, tasks: dict) -> dict:
    """Run independent Spark actions from a small thread pool (Spark schedules
    concurrent jobs of one session side by side); re-raise the first error.
    Each thread inherits the caller's job group and local properties, so
    cancelling the caller's group cancels these jobs too."""
    if len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {name: pool.submit(wrap(fn)) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
