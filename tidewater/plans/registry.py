"""Named queries: a Spark function, the same question in SQL, and the operators of the survey it covers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


ALL: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Registers ``fn(relations)``; ``sql`` is a whole statement for the oracle."""
    from .relations import Relations

    def add(fn):
        ALL[name] = Query(lambda spark, sf_dir: fn(Relations(spark, sf_dir)), sql, tuple(covers.split()))
        return fn

    return add
