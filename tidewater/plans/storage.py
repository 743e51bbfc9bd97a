"""Sources, versioned tables, file manifests, the fact state machine and streams as queries over real files.

Each query writes under the shared scratch folder and returns what can be said about it in SQL; what depends on paths
and times of files has no SQL.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import table_checksum
from ..operators.profile import file_lags
from ..sources import raw
from ..sources.control import listing, verified_copy, verified_move
from ..sources.store import VersionedTable
from ..streaming.events import as_stream, late_aware_counts, upsert_stream
from ..streaming.events import stream_sessions as session_stream
from .histories import last_days
from .registry import query
from .relations import SQL_USER_SNAPSHOTS, Relations


def _days(r: Relations) -> DataFrame:
    return r.user_snapshots.select("user_id", "day", "kind", "events")


@query("raw_csv_round_trip", "S1 S7 P1", """SELECT event_id::VARCHAR AS event_id, event_type, props, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events""")
def raw_csv_round_trip(r: Relations) -> DataFrame:
    path = r.folder("csv")
    raw.write_raw_csv(r.table("events").select(F.col("event_id").cast("string"), "event_type", "props", F.to_date("ts").alias("ingestion_date")), path, "ingestion_date")
    back = raw.read_raw_csv(r.spark, path, ["event_id", "event_type", "props"])
    return back.select("event_id", "event_type", "props", F.col("ingestion_date").cast("string").alias("day"))


@query("environment_view_scan", "S2 S3 S13 S27", "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def environment_view_scan(r: Relations) -> DataFrame:
    return raw.environment_view(r.table("events"), f"env_events_{uuid.uuid4().hex[:8]}").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("versioned_table_state", "S9 S10 S11 S12 S16 S17 S18 S19 S20 S22 S23 S24", f"""WITH {SQL_USER_SNAPSHOTS}
SELECT 'overwritten' AS step, count(*)::BIGINT AS n, sum(events)::BIGINT AS events FROM usnap WHERE user_id % 2 = 0
UNION ALL SELECT 'appended', count(*), sum(events)::BIGINT FROM usnap
UNION ALL SELECT 'updated', count(*), sum(CASE WHEN kind = 'click' THEN 0 ELSE events END)::BIGINT FROM usnap
UNION ALL SELECT 'deleted', count(*), sum(CASE WHEN kind = 'click' THEN 0 ELSE events END)::BIGINT FROM usnap WHERE kind <> 'view'
UNION ALL SELECT 'restored', count(*), sum(events)::BIGINT FROM usnap UNION ALL SELECT 'cloned', count(*), sum(events)::BIGINT FROM usnap UNION ALL SELECT 'compacted', count(*), sum(events)::BIGINT FROM usnap UNION ALL SELECT 'truncated', 0, NULL""")
def versioned_table_state(r: Relations) -> DataFrame:
    table, days = VersionedTable(r.spark, r.folder("table"), ("kind",)), _days(r)
    versions = {"overwritten": table.overwrite(days.where("user_id % 2 = 0")), "appended": table.append(days.where("user_id % 2 <> 0")), "updated": table.update(F.col("kind") == "click", {"events": F.lit(0).cast("long")}), "deleted": table.delete(F.col("kind") == "view")}
    versions["restored"] = table.restore(versions["appended"])
    frames = {name: table.read(v) for name, v in versions.items()}
    frames["cloned"] = table.clone(r.folder("clone")).read()
    table.compact(["user_id", "day"])
    frames["compacted"] = table.read()
    table.truncate()
    frames["truncated"] = table.read()
    out = None
    for name, df in frames.items():
        one = df.agg(F.lit(name).alias("step"), F.count(F.lit(1)).alias("n"), F.sum("events").alias("events"))
        out = one if out is None else out.unionByName(one)
    return out


@query("versioned_table_history", "S21 S26", """SELECT * FROM (VALUES ('all', 0, 'overwrite', 1, 0), ('all', 1, 'append', 2, 0), ('all', 2, 'truncate', 0, 0), ('all', 3, 'restore 0', 1, 0), ('kept', 0, 'overwrite', 1, 0), ('kept', 1, 'append', 2, 0), ('kept', 2, 'truncate', 0, 0), ('kept', 3, 'restore 0', 1, 0), ('vacuumed', 3, 'restore 0', 1, 1)) AS t(step, version, operation, parts, parts_gone)""")
def versioned_table_history(r: Relations) -> DataFrame:
    """What the history says before a vacuum, after one that retains 720 hours, and after one that retains none."""
    table, days = VersionedTable(r.spark, r.folder("history")), _days(r)
    table.overwrite(days)
    table.append(days)
    table.truncate()
    table.restore(0)
    shown = lambda step, gone: table.history().select(F.lit(step).alias("step"), F.col("version").cast("int"), "operation", "parts", F.lit(gone).alias("parts_gone"))
    before = shown("all", 0)
    kept = shown("kept", table.vacuum())
    return before.unionByName(kept).unionByName(shown("vacuumed", table.vacuum(retain_hours=0)))


@query("clustered_files_skipped", "S25", f"""WITH {SQL_USER_SNAPSHOTS} SELECT count(*)::BIGINT AS n, true AS fewer_files FROM usnap WHERE user_id < 10""")
def clustered_files_skipped(r: Relations) -> DataFrame:
    """After clustering, the ranges in the footers let a filter on the key pass over files."""
    table = VersionedTable(r.spark, r.folder("clustered"))
    table.overwrite(_days(r).repartition(8, "day"))
    table.compact(["user_id", "day"], files=8)
    files = table.read().groupBy(F.input_file_name().alias("file")).agg(F.min("user_id").alias("low"), F.max("user_id").alias("high"))
    met = files.agg((F.count_if(F.col("low") < 10) < F.count(F.lit(1))).alias("fewer_files"))
    return table.read().where("user_id < 10").agg(F.count(F.lit(1)).alias("n")).join(met, F.lit(True))


@query("partition_pruned_month", "S6 S11 G11", """SELECT month(l_shipdate)::INT AS month, count(*)::BIGINT AS n FROM lineitem WHERE year(l_shipdate) = 1997 AND month(l_shipdate) = 3 GROUP BY 1""")
def partition_pruned_month(r: Relations) -> DataFrame:
    """A month of a fact that is partitioned by year and month reads that month's files alone."""
    table = VersionedTable(r.spark, r.folder("months"), ("year", "month"))
    when = r.lines.select("order_id", "amount", F.year("shipped").alias("year"), F.month("shipped").alias("month"))
    table.overwrite(when.repartition("year", "month"))
    return table.read().where("year = 1997 AND month = 3").groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("table_checksum", "A11", f"""WITH {SQL_USER_SNAPSHOTS} SELECT * FROM (SELECT 'shuffled' AS step, count(*)::BIGINT AS n, true AS same FROM usnap UNION ALL SELECT 'one row changed', count(*), false FROM usnap UNION ALL SELECT 'one row twice', count(*) + 1, false FROM usnap)""")
def checksum(r: Relations) -> DataFrame:
    """A table's checksum doesn't depend on the order of its rows, and tells one changed or repeated row."""
    days = _days(r)
    top = days.agg(F.max(F.struct("user_id", "day")).alias("top"))
    one = days.join(F.broadcast(top), F.struct("user_id", "day") == F.col("top"), "left_semi")  # broadcast: one row
    is_top = F.struct("user_id", "day") == F.col("top")
    others = days.join(F.broadcast(top), F.lit(True)).withColumn("events", F.when(is_top, F.col("events") + 1).otherwise(F.col("events"))).select(*days.columns)
    whole, out = table_checksum(days), None
    base = whole.select(*[F.col(c).alias(f"base_{c}") for c in whole.columns])
    for step, df in {"shuffled": days.repartition(7), "one row changed": others, "one row twice": days.unionByName(one)}.items():
        got = table_checksum(df).join(base, F.lit(True))
        same = F.struct(*whole.columns).eqNullSafe(F.struct(*[F.col(f"base_{c}").alias(c) for c in whole.columns]))
        row = got.select(F.lit(step).alias("step"), F.col(whole.columns[0]).cast("long").alias("n"), same.alias("same"))
        out = row if out is None else out.unionByName(row)
    return out


@query("file_metadata_scan", "S4 S5 S6", f"""WITH {SQL_USER_SNAPSHOTS} SELECT day::VARCHAR AS day, 1::BIGINT AS files, count(*)::BIGINT AS n, true AS named, true AS fresh FROM usnap GROUP BY day""")
def file_metadata_scan(r: Relations) -> DataFrame:
    """Files and rows of each daily extract, by the file's metadata and by the name each row comes with."""
    path = r.folder("files")
    raw.append_daily_parquet(_days(r).withColumnRenamed("day", "ingestion_date"), path)
    scan = r.spark.read.parquet(path)
    lags = file_lags(raw.file_metadata(scan, F.to_date("ingestion_date").alias("day"))).select(F.col("day").alias("at"))
    files = raw.file_metadata(scan, F.to_date("ingestion_date").alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("files"), F.min("file_name").alias("file_name"), F.min(F.to_date("modified_at") > F.col("day")).alias("fresh"))
    tagged = scan.select(F.to_date("ingestion_date").alias("of"), F.substring_index(F.input_file_name(), "/", -1).alias("tag"))
    rows = tagged.groupBy("of").agg(F.count(F.lit(1)).alias("n"), F.max("tag").alias("tag"))
    out = files.join(rows, F.col("day") == F.col("of")).join(lags, F.col("day") == F.col("at"), "left_semi")
    return out.select(F.col("day").cast("string").alias("day"), "files", "n", (F.col("tag") == F.col("file_name")).alias("named"), "fresh")


@query("verified_tree_move", "S15", f"""WITH {SQL_USER_SNAPSHOTS} SELECT count(DISTINCT day)::BIGINT AS files, count(*)::BIGINT AS n, true AS source_gone FROM usnap""")
def verified_tree_move(r: Relations) -> DataFrame:
    """A tree of daily files, copied and then moved; both are compared file by file."""
    source, copy, moved = (r.folder(n) for n in ("tree", "copy", "moved"))
    raw.append_daily_parquet(_days(r), source, "day")
    verified_copy(r.spark, source, copy)
    verified_move(r.spark, source, moved)
    top = r.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    gone = not top.getFileSystem(r.spark.sparkContext._jsc.hadoopConfiguration()).exists(top)
    files = sum(name.endswith(".parquet") for name in listing(r.spark, moved))
    return r.spark.read.parquet(moved).agg(F.lit(files).cast("long").alias("files"), F.count(F.lit(1)).alias("n"), F.lit(gone).alias("source_gone"))


@query("fact_cycle_state", "PM1 PM3 SD4 INC2 INC6 INC8 INC9 DC10", f"""WITH {SQL_USER_SNAPSHOTS}, m AS (SELECT max(day) AS d FROM usnap), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rk FROM usnap, m WHERE kind <> 'error' AND day <= d - 1)
SELECT user_id, day::VARCHAR AS day, kind, events FROM k WHERE rk = 1""")
def fact_cycle(r: Relations) -> DataFrame:
    """A fact's whole cycle, apply, validate and commit twice, over daily files: the state it leaves behind the last closed day."""
    from .cycle import run_cycle

    last = last_days(r, 1)[0]
    table = run_cycle(r.spark, r.folder("cycle"), _days(r), [last - timedelta(days=4), last - timedelta(days=1)])
    return table.withColumn("day", F.col("day").cast("string"))


@query("stream_windowed_counts", "2.12", """SELECT strftime(date_trunc('day', CAST(ts AS TIMESTAMP)), '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL""")
def stream_windowed_counts(r: Relations) -> DataFrame:
    """Daily counts from a stream whose files come in any order, available-now, against the batch answer."""
    out = late_aware_counts(as_stream(r.spark, f"{r.sf_dir}/events.parquet", r.folder("in")), r.folder("counts"))
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("stream_sessions", "2.12", """WITH s AS (SELECT user_id, CAST(ts AS TIMESTAMP) AS t, lag(CAST(ts AS TIMESTAMP)) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), g AS (SELECT user_id, t, sum((p IS NULL OR t - p >= INTERVAL 30 MINUTE)::INT) OVER (PARTITION BY user_id ORDER BY t) AS s FROM s), x AS (SELECT user_id, s, count(*) AS n FROM g GROUP BY ALL)
SELECT user_id, count(*)::BIGINT AS sessions, max(n)::BIGINT AS longest FROM x GROUP BY user_id""")
def stream_sessions(r: Relations) -> DataFrame:
    """Sessions from a stream of four files, against the batch answer."""
    found = session_stream(as_stream(r.spark, f"{r.sf_dir}/events.parquet", r.folder("in"), files=4), r.folder("sessions"), "30 minutes")
    return found.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.max("n").alias("longest"))


@query("stream_upsert_latest", "INC3 2.12", """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk FROM events) WHERE rk = 1""")
def stream_upsert_latest(r: Relations) -> DataFrame:
    """The newest event of each user, kept by a stream that merges each batch into a versioned table once."""
    table = VersionedTable(r.spark, r.folder("latest"))
    upsert_stream(as_stream(r.spark, f"{r.sf_dir}/events.parquet", r.folder("in"), files=4), table, ["user_id"], ["ts", "event_id"], r.folder("checkpoint"))
    return table.read().select("user_id", "event_id", "event_type")
