"""Tables computed from a folder of tables, written once and shared by all queries of a session."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fs import Files, release, times_cleared, written

_MADE: dict[tuple, DataFrame] = {}
_LOCKS: dict[tuple, threading.Lock] = {}
_GUARD = threading.Lock()


def derived(spark: SparkSession, folder: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` of ``folder``: made and written to the shared folder at the first call, read after that.

    The key holds names, sizes and times of the folder's files, so a changed folder is computed anew.
    """
    key = (spark.sparkContext.applicationId, folder, name, Files(spark).fingerprint(folder), times_cleared())
    with _GUARD:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        if key not in _MADE:
            _MADE[key] = written(make(), f"derived-{name}")
            release(spark)
        return _MADE[key]
