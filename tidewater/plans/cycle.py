"""One fact entity from daily files to committed state, as a small assembled application."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.typing import Typing
from ..operators.contracts import Contract
from ..operators.drift import DriftRegistry
from ..operators.incremental import FactPipeline, Watermarks
from ..operators.manifest import Manifest
from ..sources.raw import append_daily_parquet
from ..sources.store import VersionedTable

DAY = "day"
CONTRACT = Contract.from_dict(
    {
        "table": "user_days",
        "grain": ["user_id"],
        "columns": [{"name": "user_id", "type": "bigint", "nullable": False}, {"name": DAY, "type": "date"}, {"name": "kind", "type": "string", "accepted_values": ["view", "click", "signup", "purchase"]}, {"name": "events", "type": "bigint", "min": 1}],
        "quality_rules": [{"rule": "no_duplicates"}],
    }
)


def assemble(spark: SparkSession, root: str, files: str, cutoff: date | None = None) -> FactPipeline:
    """The pipeline of ``user_days`` with all its tables under ``root``; ``files`` holds the daily extracts."""
    table = lambda name: VersionedTable(spark, f"{root}/{name}")
    scan = lambda: spark.read.parquet(files)
    return FactPipeline(
        spark, "user_days", ["user_id"], Typing(), CONTRACT, scan, DAY, table("state"), table("quarantine"), table("quarantine_history"), Watermarks(table("watermarks"), spark),
        Manifest(table("manifest"), "user_days", scan, DAY), DriftRegistry(f"{root}/control", spark), cutoff,
    )


def seed(pipeline: FactPipeline, first: date) -> None:
    """The days up to ``first`` as a proven baseline: state, manifest, schema and watermark."""
    df = pipeline.scan()
    pipeline.drift.bootstrap(pipeline.entity, df, "setup", "first baseline")
    expected = pipeline.expected(None, first)
    pipeline.target.overwrite(expected, "baseline")
    pipeline.manifest.bootstrap(first)
    pipeline.watermarks.seed(pipeline.entity, first)


def run_cycle(spark: SparkSession, root: str, snapshots: DataFrame, closed: list[date]) -> DataFrame:
    """Writes ``snapshots`` as daily files, seeds the first day of ``closed`` and runs a cycle to each of the others."""
    files = f"{root}/files"
    append_daily_parquet(snapshots.select("user_id", DAY, "kind", "events"), files, DAY)
    seed(assemble(spark, root, files, closed[0]), closed[0])
    for cutoff in closed[1:]:
        pipeline = assemble(spark, root, files, cutoff)
        pipeline.apply()
        pipeline.validate()
        pipeline.commit()
    return pipeline.target.read().select("user_id", F.col(DAY), "kind", "events")
