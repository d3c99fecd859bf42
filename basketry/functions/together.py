"""Independent jobs submitted side by side, so that small tables do not leave a cluster idle."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def together(spark: SparkSession, steps: list[Callable[[], T]], at_once: int | None = None) -> list[T]:
    """The results in the order given; the first failure is raised once all have ended.

    All steps run at the same time, or ``at_once`` of them.
    """
    with ThreadPoolExecutor(max_workers=at_once or len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [done.result() for done in running]
