"""How long the files of shuffles stay on disk."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
#: Per session, how many blocks run and what the setting was before the first of them.
_INSIDE: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()


@contextmanager
def freed_at_end(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles that begins in this block goes when the query ends.

    By default it stays until the driver happens to collect garbage, so that the shuffles of table after table
    add up. Nothing is lost: a query that is run again shuffles again. Blocks may run side by side; the last one
    to end restores the setting.
    """
    with _LOCK:
        count, before = _INSIDE.get(spark) or (0, spark.conf.get(_SETTING, None))
        _INSIDE[spark] = count + 1, before
        spark.conf.set(_SETTING, "true")
    try:
        yield
    finally:
        with _LOCK:
            count, before = _INSIDE.pop(spark)
            if count > 1:
                _INSIDE[spark] = count - 1, before
            elif before is None:
                spark.conf.unset(_SETTING)
            else:
                spark.conf.set(_SETTING, before)
