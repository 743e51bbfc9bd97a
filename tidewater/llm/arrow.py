"""Arrow batches of whole texts through Python workers, with bounded memory."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: What this worker keeps from task to task: one object at most.
_kept: dict[str, object] = {}


def kept(key: str, make: Callable[[], object]):
    """The object of this key, made anew unless the worker's last task has used it; what another operator has left is dropped first."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def _give_back() -> None:
    """Returns freed memory to the system, so that workers that wait hold little."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def small_batches(spark: SparkSession, most: str = "2m") -> None:
    """Bounds the bytes of an Arrow batch of whole texts, unless the session has a bound of its own.

    Plans take the bound when they run, after the operator has returned, so it stays set. It never changes results.
    """
    if spark.conf.get(BATCH_BYTES).lower() in ("67108864b", "64mb", "64m"):
        spark.conf.set(BATCH_BYTES, most)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` in small batches; ``keeps``: ``run`` uses ``kept``."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            _kept.clear()
        try:
            yield from run(batches)
        finally:
            _give_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(tidy, schema)
