"""Apply, validate, commit: incremental facts behind a watermark that only reads days whose files are closed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.typing import Typing, apply_typing
from ..sources.raw import file_metadata
from ..sources.store import VersionedTable
from .contracts import Contract, check_grain, latest_valid
from .drift import DriftRegistry
from .manifest import Manifest
from .state import compare_batch, latest, upsert

COMMITTED, PENDING, REPAIR = "COMMITTED", "PENDING_VALIDATION", "REPAIR_PENDING_VALIDATION"
#: Which state may follow which.
TRANSITIONS = {COMMITTED: {PENDING, REPAIR}, PENDING: {COMMITTED, REPAIR}, REPAIR: {COMMITTED, REPAIR}}


class StateError(RuntimeError):
    pass


def maturity_cutoff(files: DataFrame) -> DataFrame:
    """One row: the greatest day all of whose files were modified on a later date. ``files``: day, modified_at."""
    days = files.groupBy("day").agg(F.min(F.to_date("modified_at")).alias("first"))
    return days.where(F.col("first") > F.col("day")).agg(F.max("day").alias("cutoff"))


def pending_range(df: DataFrame, day_column: str, committed: date | None, cutoff: date | None) -> DataFrame:
    """Half-open (committed, cutoff]; no bound where committed is null, nothing where cutoff is null."""
    if cutoff is None:
        return df.limit(0)
    out = df.where(F.col(day_column) <= F.lit(cutoff))
    return out if committed is None else out.where(F.col(day_column) > F.lit(committed))


class Watermarks:
    """The control table: one row an entity."""

    SCHEMA = "entity string, committed date, candidate date, status string, updated_at timestamp"

    def __init__(self, table: VersionedTable, spark: SparkSession):
        self.table, self.spark = table, spark

    def get(self, entity: str):
        rows = self.table.read().where(F.col("entity") == entity).take(2) if self.table.exists() else []
        if len(rows) > 1:
            raise StateError(f"{entity} has more than one watermark")
        return rows[0] if rows else None

    def seed(self, entity: str, committed: date | None) -> bool:
        """Adds a watermark where there is none; never resets one."""
        if self.get(entity):
            return False
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        self.table.append(self.spark.createDataFrame([(entity, committed, None, COMMITTED, now)], self.SCHEMA))
        return True

    def move(self, entity: str, expect: str, status: str, committed: date | None, candidate: date | None) -> None:
        """Compare and set: commits on the version it has looked at, so of two movers one fails."""
        version, df = self.table.newest()
        rows = df.where(F.col("entity") == entity).take(2)
        row = rows[0] if len(rows) == 1 else None
        if row is None or row["status"] != expect:
            raise StateError(f"{entity} is {row and row['status']}, not {expect}")
        if status not in TRANSITIONS[expect]:
            raise StateError(f"{expect} can't become {status}")
        value = lambda d: F.lit(d).cast("date")
        new = {"status": F.lit(status), "committed": value(committed), "candidate": value(candidate), "updated_at": F.current_timestamp()}
        moved = df.select(*[F.when(F.col("entity") == entity, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns])
        self.table.overwrite(moved, f"{entity} {status}", version)


@dataclass
class FactPipeline:
    """One fact entity. ``scan`` reads the raw files afresh; ``day_column`` is the snapshot column."""

    spark: SparkSession
    entity: str
    keys: list[str]
    typing: Typing
    contract: Contract
    scan: Callable[[], DataFrame]
    day_column: str
    target: VersionedTable
    quarantine: VersionedTable
    quarantine_history: VersionedTable
    watermarks: Watermarks
    manifest: Manifest
    drift: DriftRegistry
    cutoff_override: date | None = None

    def cutoff(self) -> date | None:
        if self.cutoff_override:
            return self.cutoff_override
        files = file_metadata(self.scan(), F.to_date(self.day_column).alias("day")).select("day", "modified_at")
        return maturity_cutoff(files).first()["cutoff"]

    def _batch(self, committed: date | None, cutoff: date):
        raw = pending_range(self.scan(), self.day_column, committed, cutoff)
        typed = self.drift.evaluate(self.entity, apply_typing(raw, self.typing))
        return latest_valid(typed, self.contract, self.day_column)

    def apply(self) -> str:
        """Merges the closed days after the watermark; what it did, or why nothing was to be done."""
        check_grain(self.contract, self.keys)
        row = self.watermarks.get(self.entity)
        if row is None:
            raise StateError(f"{self.entity} has no watermark")
        if row["committed"] is not None:
            self.manifest.assert_committed(row["committed"])
        if row["status"] == PENDING:
            return "pending"
        if row["status"] != COMMITTED or row["candidate"] is not None:
            raise StateError(f"{self.entity} is {row['status']}")
        cutoff = self.cutoff()
        if cutoff is None or cutoff == row["committed"]:
            return "nothing closed"
        if row["committed"] is not None and row["committed"] > cutoff:
            raise StateError(f"{self.entity}: committed {row['committed']} is after what is closed, {cutoff}")
        if pending_range(self.scan(), self.day_column, row["committed"], cutoff).isEmpty():
            return "no rows"
        state, verdict = self._batch(row["committed"], cutoff)
        self.target.upsert(state, self.keys)
        rejects = verdict.quarantine
        self.quarantine.overwrite(rejects)
        stamped = rejects.withColumn("candidate", F.lit(cutoff)).withColumn("quarantined_at", F.current_timestamp())
        # keyed by candidate: a repeated apply replaces its own rejects instead of adding them again
        if self.quarantine_history.exists():
            self.quarantine_history.delete(F.col("candidate") == F.lit(cutoff))
        self.quarantine_history.append(stamped)
        self.watermarks.move(self.entity, COMMITTED, PENDING, row["committed"], cutoff)
        return "applied"

    def expected(self, committed: date | None, candidate: date) -> DataFrame:
        return self._batch(committed, candidate)[0]

    def validate(self) -> DataFrame | None:
        """Rebuilds the batch, compares it with the table and stages the files; raises on any failure."""
        row = self.watermarks.get(self.entity)
        if row["status"] == COMMITTED:
            return None
        if row["status"] != PENDING:
            raise StateError(f"{self.entity} is {row['status']}")
        expected, actual = self.expected(row["committed"], row["candidate"]), self.target.read()
        checks = compare_batch(expected, actual, self.keys)
        ahead = actual.where(F.col(self.day_column) > F.lit(row["candidate"])).agg(F.lit("future_rows").alias("check"), F.count(F.lit(1)).alias("failures"), (F.count(F.lit(1)) == 0).alias("passed"))
        checks = checks.unionByName(ahead)
        failed = checks.where("NOT passed").collect()
        if failed:
            raise StateError(f"{self.entity}: {[tuple(r) for r in failed]}")
        self.manifest.stage(row["committed"], row["candidate"])
        return checks

    def commit(self) -> bool:
        """Promotes the manifest, then the watermark; a crash between the two is made good by repeating."""
        row = self.watermarks.get(self.entity)
        if row["status"] == COMMITTED:
            return False
        if row["status"] != PENDING or row["candidate"] is None:
            raise StateError(f"{self.entity} is {row['status']}")
        newest = self.scan().agg(F.max(F.to_date(self.day_column)).alias("d")).first()["d"]
        if (row["committed"] and row["committed"] > row["candidate"]) or newest is None or row["candidate"] > newest:
            raise StateError(f"{self.entity}: candidate {row['candidate']} is out of range")
        self.manifest.promote(row["committed"], row["candidate"])
        self.watermarks.move(self.entity, PENDING, COMMITTED, row["candidate"], None)
        self.manifest.assert_committed(row["candidate"])
        return True


# --- repairs


def repair_open_days(target: DataFrame, rebuilt: DataFrame, keys: list[str], day_column: str, cutoff: date) -> DataFrame:
    """State as if days after ``cutoff`` had never been read: the replayed window is merged, rows of open days go."""
    merged = upsert(target, rebuilt.select(*target.columns), keys)
    return merged.where(~F.coalesce(F.col(day_column) > F.lit(cutoff), F.lit(False)))


def verify_repair(rebuilt: DataFrame, before: DataFrame, after: DataFrame, keys: list[str], day_column: str, cutoff: date) -> DataFrame:
    """check, failures, passed: the rebuilt rows are there, no row of an open day is, and rows that weren't rebuilt are as they were."""
    checks = compare_batch(rebuilt, after, keys)
    count = lambda name, df: df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("failures"), (F.count(F.lit(1)) == 0).alias("passed"))
    open_ = after.where(F.col(day_column) > F.lit(cutoff))
    rest = before.where(~F.coalesce(F.col(day_column) > F.lit(cutoff), F.lit(False))).join(rebuilt.select(*keys), keys, "left_anti").select(*after.columns)
    return checks.unionByName(count("open_day_rows", open_)).unionByName(count("untouched_changed", rest.exceptAll(after)))


def repair_maturity(pipeline: FactPipeline, cutoff: date) -> DataFrame:
    """Takes back what open days have left in a committed fact: marks the repair, replays, verifies, commits; a failed check restores the version before.

    A repair that broke off is taken up again by the same call.
    """
    row, keys, day = pipeline.watermarks.get(pipeline.entity), pipeline.keys, pipeline.day_column
    if row is None or row["status"] not in (COMMITTED, REPAIR) or (row["status"] == REPAIR and row["candidate"] != cutoff):
        raise StateError(f"{pipeline.entity} can't be repaired to {cutoff} as {row and row['status']}")
    if row["status"] == COMMITTED:
        pipeline.watermarks.move(pipeline.entity, COMMITTED, REPAIR, row["committed"], cutoff)
    rebuilt = pipeline.expected(None, cutoff)
    version, before = pipeline.target.newest()
    pipeline.target.overwrite(repair_open_days(before, rebuilt, keys, day, cutoff), "repair", version)
    checks = verify_repair(rebuilt.select(*before.columns), before, pipeline.target.read(), keys, day, cutoff)
    failed = checks.where("NOT passed").collect()
    if failed:
        pipeline.target.restore(version)
        raise StateError(f"{pipeline.entity}: {[tuple(r) for r in failed]}")
    pipeline.watermarks.move(pipeline.entity, REPAIR, COMMITTED, cutoff, None)
    return checks


def restore_contaminated(target: DataFrame, history: DataFrame, keys: list[str], day_column: str, cutoff: date) -> DataFrame:
    """Only ids whose state comes from a day after ``cutoff`` go back to their last state up to it; those without one go."""
    bad = F.coalesce(F.col(day_column) > F.lit(cutoff), F.lit(False))
    ids = target.where(bad).select(*keys)
    older = history.where(F.col(day_column) <= F.lit(cutoff)).join(ids, keys, "left_semi")
    return target.where(~bad).unionByName(latest(older, keys, day_column).select(*target.columns))


def merge_backfill(daily: DataFrame, backfill: DataFrame, keys: list[str], day_column: str) -> DataFrame:
    """Both sources by name; where both have a key on a day, the daily extract wins."""
    rest = backfill.join(daily.select(*keys, day_column).distinct(), [*keys, day_column], "left_anti")
    return daily.withColumn("origin", F.lit("daily")).unionByName(rest.withColumn("origin", F.lit("backfill")), allowMissingColumns=True)


def newest_snapshot(df: DataFrame, day_column: str) -> DataFrame:
    """The rows of the last day."""
    newest = df.agg(F.max(day_column).alias("_day"))
    return df.join(F.broadcast(newest), F.col(day_column) == F.col("_day"), "left_semi")  # broadcast: one row


def overwrite_references(tables: dict[str, VersionedTable], raw: dict[str, DataFrame], drift: DriftRegistry, day_column: str, keys: dict[str, list[str]]) -> None:
    """Reference tables from their latest snapshot. All schemas are judged before the first is written, so one drift stops all."""
    ready = {}
    for name, df in raw.items():
        ready[name] = drift.evaluate(name, newest_snapshot(df, day_column))
    for name, df in ready.items():
        tables[name].overwrite(latest(df, keys[name], day_column))


def upsert_snapshot_fact(table: VersionedTable, rows: DataFrame, keys: list[str]) -> None:
    """Snapshot facts keep every day: the composite grain holds the day."""
    table.upsert(rows, keys)
