"""Submitting independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

# Small jobs submitted at a time: enough to hide their latency, each still distributed.
CONCURRENT_JOBS = 4


def side_by_side(
    spark: SparkSession, job: Callable[[Item], Result], items: Iterable[Item]
) -> list[Result]:
    """Run ``job`` for every item; the first failure is raised after the others finish."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), items))
