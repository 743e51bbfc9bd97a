"""Slowly changing dimensions of type 2 from daily snapshots: full backfill, incremental steps, validators."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hashed
from ..sources.workspace import shared_folder
from .state import any_of, latest

TECHNICAL = ("version_hash", "valid_from", "valid_to", "is_current", "valid_from_source", "source_snapshot")


@dataclass(frozen=True)
class HistoryPolicy:
    """Which attributes make versions and which timestamps are trusted as their boundaries.

    ``initial`` and ``changes`` name timestamp columns preferred over the snapshot for a key's first and later versions, if
    they are not after it (``compare="timestamp"``) or not after its day (``compare="date"``). ``watch`` names columns whose
    change is counted as an alert. ``ordered`` repairs a boundary that isn't after the one before by the snapshot.
    """

    key: str
    type2: tuple[str, ...]
    type1: tuple[str, ...] = ()
    snapshot: str = "snapshot"
    initial: str | None = None
    changes: str | None = None
    compare: str = "timestamp"
    ordered: bool = False
    watch: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.type2, *self.type1]


def _trusted(policy: HistoryPolicy, name: str | None) -> tuple[Column, Column]:
    """Boundary and its source's name: the named timestamp if trusted, else the snapshot."""
    snapshot = F.col(policy.snapshot).cast("timestamp")
    if name is None:
        return snapshot, F.lit("snapshot")
    ts = F.col(name)
    ok = F.coalesce(ts <= snapshot if policy.compare == "timestamp" else F.to_date(ts) <= F.to_date(snapshot), F.lit(False))
    return F.when(ok, ts).otherwise(snapshot), F.when(ok, F.lit(name)).otherwise(F.lit("snapshot"))


def _choose(first: Column, a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    return F.when(first, a[0]).otherwise(b[0]), F.when(first, a[1]).otherwise(b[1])


def change_points(snapshots: DataFrame, policy: HistoryPolicy) -> DataFrame:
    """Snapshots whose type 2 hash differs from the key's snapshot before, gaps or not; with ``is_first``."""
    order = Window.partitionBy(policy.key).orderBy(policy.snapshot)
    marked = snapshots.withColumn("version_hash", hashed(*policy.type2)).withColumn("_before", F.lag("version_hash").over(order))
    return marked.where(F.col("_before").isNull() | (F.col("_before") != F.col("version_hash"))).withColumn("is_first", F.col("_before").isNull()).drop("_before")


def backfill(snapshots: DataFrame, policy: HistoryPolicy) -> DataFrame:
    """The whole history from all snapshots: versions with half-open intervals, type 1 values of the last snapshot on all of them."""
    key = policy.key
    points = change_points(snapshots, policy)
    at, source = _choose(F.col("is_first"), _trusted(policy, policy.initial), _trusted(policy, policy.changes))
    points = points.withColumn("valid_from", at).withColumn("valid_from_source", source)
    if policy.ordered:
        before = F.lag("valid_from").over(Window.partitionBy(key).orderBy(policy.snapshot))
        late = F.coalesce(F.col("valid_from") <= before, F.lit(False))
        points = points.withColumn("_late", late)
        points = points.withColumn("valid_from", F.when(F.col("_late"), F.col(policy.snapshot).cast("timestamp")).otherwise(F.col("valid_from")))
        points = points.withColumn("valid_from_source", F.when(F.col("_late"), F.lit("snapshot")).otherwise(F.col("valid_from_source")))
    valid_to = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from", policy.snapshot))
    points = points.select(key, *policy.type2, "version_hash", "valid_from", valid_to.alias("valid_to"), "valid_from_source", F.to_date(policy.snapshot).alias("source_snapshot"))
    if policy.type1:
        newest = latest(snapshots.select(key, policy.snapshot, *policy.type1), [key], policy.snapshot).select(key, *policy.type1)
        points = points.join(newest, key)
    return points.withColumn("is_current", F.col("valid_to").isNull()).select(*policy.columns, *TECHNICAL)


def classify_snapshot(snapshots: DataFrame, policy: HistoryPolicy, day: date) -> DataFrame:
    """Every key of ``day`` and of the snapshot day before, with its class against its last observation: new, type2, type1,
    unchanged or gone; ``reappeared`` if it was missing in the snapshot before; ``alert`` if a watched column changed."""
    key, at = policy.key, policy.snapshot
    today = snapshots.where(F.col(at) == F.lit(day))
    older = snapshots.where(F.col(at) < F.lit(day))
    previous = older.agg(F.max(at).alias("_prev"))
    # one row a key, combined in each task before the exchange; no key's past is sorted
    rows = F.struct(at, *policy.type2, *policy.type1)
    last = older.groupBy(key).agg(F.max_by(rows, F.col(at)).alias("_row")).select(key, "_row.*")
    attributes = [*policy.type2, *policy.type1]
    held = last.select(F.col(key).alias("_key"), F.col(at).alias("_at"), hashed(*policy.type2).alias("_hash"), *[F.col(c).alias(f"_{c}") for c in attributes])
    both = today.withColumn("version_hash", hashed(*policy.type2)).withColumn("_here", F.lit(1)).join(held, F.col(key) == F.col("_key"), "full_outer").join(F.broadcast(previous), F.lit(True))
    known = F.col("_key").isNotNull()
    kind = (
        F.when(F.col("_here").isNull(), "gone").when(~known, "new").when(F.col("_hash") != F.col("version_hash"), "type2")
        .when(any_of([~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in policy.type1]), "type1").otherwise("unchanged")
    )
    out = both.withColumn("class", kind).where((F.col("class") != "gone") | (F.col("_at") == F.col("_prev")))
    alert = any_of([~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in policy.watch]) & known & (F.col("class") != "gone")
    reappeared = F.coalesce((F.col("class") != "gone") & known & (F.col("_at") < F.col("_prev")), F.lit(False))
    return out.withColumn("reappeared", reappeared).withColumn("alert", alert).withColumn("_id", F.coalesce(key, "_key")).drop(key, "_key").withColumnRenamed("_id", key)


def _written(df: DataFrame) -> DataFrame:
    """A few rows a day that the steps after it read many times, stored where all executors reach them."""
    folder = f"{shared_folder(df.sparkSession)}/step-{uuid.uuid4().hex[:12]}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def apply_snapshot(target: DataFrame, snapshots: DataFrame, policy: HistoryPolicy, day: date) -> DataFrame:
    """``target`` after one more snapshot day. Replays change nothing; a version that can't be ordered raises."""
    key = policy.key
    repeated = snapshots.where(F.col(policy.snapshot) == F.lit(day)).groupBy(key).count().where("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"snapshot {day} has repeated keys")
    classes = _written(classify_snapshot(snapshots, policy, day).where(F.col("class").isin("new", "type2", "type1")))
    touched = classes.where(F.col("class").isin("new", "type2")).select(key)
    held = target.join(touched, key, "left_semi").groupBy(key).agg(F.max("valid_from").alias("_top"), F.max("source_snapshot").alias("_seen"), F.collect_set(F.struct("valid_from", "version_hash")).alias("_versions"))
    events = classes.where(F.col("class").isin("new", "type2")).join(held, key, "left")
    events = events.where(~((F.col("class") == "new") & F.coalesce(F.col("_seen") >= F.lit(day), F.lit(False))))
    at, source = _choose(F.col("class") == "new", _trusted(policy, policy.initial), _trusted(policy, policy.changes))
    events = events.withColumn("_at", at).withColumn("_source", source)
    same = F.coalesce(F.exists("_versions", lambda v: v["valid_from"] == F.col("_at")), F.lit(False))
    replay = F.coalesce(F.exists("_versions", lambda v: (v["valid_from"] == F.col("_at")) & (v["version_hash"] == F.col("version_hash"))), F.lit(False))
    snapshot = F.col(policy.snapshot).cast("timestamp")
    fate = (
        F.when((F.col("class") == "new") & F.col("_top").isNotNull(), "no evidence").when(replay, "replay").when(same, "collision").when(F.col("_top").isNull() | (F.col("_at") > F.col("_top")), "insert")
        .when(snapshot > F.col("_top"), "insert at snapshot").otherwise("unordered")
    )
    events = _written(events.withColumn("_fate", fate).drop("_versions"))
    bad = events.where(F.col("_fate").isin("no evidence", "collision", "unordered")).select(key, "_fate").take(5)
    if bad:
        raise ValueError(f"snapshot {day} can't be applied: {[tuple(r) for r in bad]}")
    late = F.col("_fate") == "insert at snapshot"
    fresh = events.where(F.col("_fate").startswith("insert")).select(
        *policy.columns, "version_hash", F.when(late, snapshot).otherwise(F.col("_at")).alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"),
        F.when(late, F.lit("snapshot")).otherwise(F.col("_source")).alias("valid_from_source"), F.to_date(policy.snapshot).alias("source_snapshot"),
    )
    # a key gets one version a day, after all it has, so that closes the open one; nothing is ordered anew
    new = fresh.select(F.col(key).alias("_of"), F.col("valid_from").alias("_next"))
    closed = target.join(new, F.col(key) == F.col("_of"), "left").withColumn("valid_to", F.coalesce("valid_to", "_next")).withColumn("is_current", F.col("valid_to").isNull()).drop("_of", "_next")
    return spread_type1(closed.unionByName(fresh), classes.where(F.col("class").isin("type1", "type2")), policy)


def spread_type1(history: DataFrame, rows: DataFrame, policy: HistoryPolicy) -> DataFrame:
    """Type 1 values of ``rows`` on every version of their keys; null is a value too."""
    if not policy.type1:
        return history.select(*policy.columns, *TECHNICAL)
    new = rows.select(F.col(policy.key).alias("_of"), *[F.col(c).alias(f"_new_{c}") for c in policy.type1])
    joined = history.join(new, F.col(policy.key) == F.col("_of"), "left")
    pick = [F.when(F.col("_of").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in policy.type1 else F.col(c) for c in [*policy.columns, *TECHNICAL]]
    return joined.select(*pick)


def invariants(history: DataFrame, policy: HistoryPolicy) -> DataFrame:
    """check, failures of the rules every history keeps; one pass over one window."""
    order = Window.partitionBy(policy.key).orderBy("valid_from", "source_snapshot")
    w = history.withColumn("_next", F.lead("valid_from").over(order)).withColumn("_hash", F.lag("version_hash").over(order)).withColumn("_active", F.count_if(F.col("is_current")).over(Window.partitionBy(policy.key)))
    w = w.withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy(policy.key, "valid_from")))
    rules = {
        "null_key": F.col(policy.key).isNull(), "null_valid_from": F.col("valid_from").isNull(), "null_is_current": F.col("is_current").isNull(), "null_hash": F.col("version_hash").isNull(),
        "hash_of_type2": ~F.col("version_hash").eqNullSafe(hashed(*policy.type2)), "empty_interval": F.coalesce(F.col("valid_to") <= F.col("valid_from"), F.lit(False)),
        "current_is_open": F.col("is_current") != F.col("valid_to").isNull(), "one_current": F.col("_active") != 1, "continuous": ~F.col("valid_to").eqNullSafe(F.col("_next")),
        "no_redundant_version": F.col("_hash").eqNullSafe(F.col("version_hash")), "unique_version": F.col("_same") > 1, "known_source": ~F.col("valid_from_source").isin(*{"snapshot", policy.initial or "snapshot", policy.changes or "snapshot"}),
    }
    return as_checks(w, rules)


def validate_history(history: DataFrame, snapshots: DataFrame, policy: HistoryPolicy) -> DataFrame:
    """check, failures, passed of a history against the snapshots it comes from; with ``invariants``, the whole of what a history must keep.

    One aggregate of either by key and one join of the two.
    """
    key, at = policy.key, policy.snapshot
    order = Window.partitionBy(key).orderBy(at)
    hashes = snapshots.withColumn("_hash", hashed(*policy.type2)).withColumn("_before", F.lag("_hash").over(order))
    point = F.col("_before").isNull() | (F.col("_before") != F.col("_hash"))
    type1 = lambda: F.struct(F.lit(0), *policy.type1)
    seen = hashes.groupBy(F.col(key).alias("_of")).agg(
        F.min(at).alias("_first"), F.max(at).alias("_last"), F.max_by("_hash", at).alias("_newest"), F.max_by(type1(), F.col(at)).alias("_type1"), F.sum(point.cast("long")).alias("_points"), F.collect_set(F.when(point, F.to_date(at))).alias("_days"),
    )
    held = history.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.when(F.col("is_current"), F.col("version_hash"))).alias("_current"), F.min(type1()).alias("_least1"), F.max(type1()).alias("_most1"), F.min("source_snapshot").alias("_from"),
        F.max("valid_from").alias("_top"), F.count_if(F.col("source_snapshot").isNull()).alias("_no_snapshot"), F.countDistinct("source_snapshot").alias("_snapshots"), F.collect_set("source_snapshot").alias("_sources"),
        F.count_if(F.to_date("valid_from") > F.col("source_snapshot")).alias("_after"),
    )
    both = held.join(seen, F.col(key) == F.col("_of"), "full_outer").join(F.broadcast(snapshots.agg(F.max(at).cast("timestamp").alias("_end"))), F.lit(True))
    here = F.col("_of").isNotNull() & F.col(key).isNotNull()
    rules = {
        "keys_complete": F.col(key).isNull(), "keys_known": F.col("_of").isNull(), "versions_of_snapshots": here & (F.col("_n") != F.col("_points")), "change_days": here & (F.size(F.array_except("_days", "_sources")) > 0),
        "current_is_last_observation": here & ~F.col("_current").eqNullSafe(F.col("_newest")), "type1_of_last_observation": here & ~F.col("_most1").eqNullSafe(F.col("_type1")), "type1_on_all_versions": here & ~F.col("_least1").eqNullSafe(F.col("_most1")),
        "first_snapshot": here & (F.col("_from") != F.to_date("_first")), "source_snapshot_known": F.col("_no_snapshot") > 0, "one_version_a_snapshot": F.col("_snapshots") != F.col("_n"), "not_after_its_snapshot": F.col("_after") > 0, "not_after_last_snapshot": F.col("_top") > F.col("_end"),
    }
    return as_checks(both, rules)


def as_checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """check, failures for conditions that count a row as a failure: one aggregate for all."""
    row = df.agg(*[F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0)).alias(n) for n, c in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failures")) for n in rules]))
    return row.select(pairs.alias("p")).select("p.check", "p.failures", (F.col("p.failures") == 0).alias("passed"))


def replay_days(target: DataFrame, snapshots: DataFrame, policy: HistoryPolicy, days: list[date], write=None) -> DataFrame:
    """Applies snapshot days in order; ``write`` (a table's overwrite and read) cuts the lineage after each."""
    for day in sorted(days):
        target = apply_snapshot(target, snapshots, policy, day)
        target = write(target) if write else target
    return target
