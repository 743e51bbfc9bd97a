"""The states of a committed fact, of reference tables and of histories with trusted boundaries, over real files that change."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.drift import DriftError, DriftRegistry
from ..operators.history import HistoryPolicy, apply_snapshot, backfill, invariants, validate_history
from ..operators.incremental import FactPipeline, overwrite_references, repair_maturity
from ..operators.manifest import MutationError
from ..operators.state import multiset_difference
from ..sources.raw import append_daily_parquet
from ..sources.store import VersionedTable
from .cycle import DAY, assemble, run_cycle
from .histories import last_days, shown
from .registry import query
from .relations import SQL_PART_SNAPSHOTS, SQL_PARTS, SQL_USER_SNAPSHOTS, Relations

STATE = ("user_id", DAY, "kind", "events")


def _user_days(r: Relations) -> DataFrame:
    return r.user_snapshots.select(*STATE)


def _stored(r: Relations, df: DataFrame, name: str) -> DataFrame:
    """Written now, so that what is told is the state at this moment."""
    table = VersionedTable(r.spark, r.folder(name))
    table.overwrite(df)
    return table.read()


def _cycled(r: Relations, name: str) -> tuple[FactPipeline, str, date, date]:
    """A fact after a cycle up to the day before the last: its pipeline, the folder of its files, that day and the last."""
    root, last = r.folder(name), last_days(r, 1)[0]
    cutoff = last - timedelta(days=1)
    run_cycle(r.spark, root, _user_days(r), [last - timedelta(days=4), cutoff])
    return assemble(r.spark, root, f"{root}/files", cutoff), f"{root}/files", cutoff, last


_GATE = ("single_watermark", "at_rest", "at_the_last_closed_day", "fresh", "no_open_day", "files_as_committed")


@query("fact_gate_states", "QG2 PM4", f"""WITH {SQL_USER_SNAPSHOTS}, m AS (SELECT count(*)::BIGINT AS n FROM usnap WHERE day = (SELECT max(day) FROM usnap)),
g(state, "check", failures) AS (SELECT s, c, CASE WHEN s = 'open day' AND c = 'no_open_day' THEN n WHEN (s = 'old' AND c = 'fresh') OR (s = 'behind' AND c = 'at_the_last_closed_day') OR (s = 'pending' AND c = 'at_rest') OR (s = 'mutated' AND c IN ('files_as_committed', 'apply_stops')) THEN 1 ELSE 0 END
  FROM m, (VALUES ('committed'), ('open day'), ('old'), ('behind'), ('pending'), ('mutated')) AS a(s), (VALUES {", ".join(f"('{c}')" for c in _GATE)}) AS b(c) UNION ALL SELECT 'mutated', 'apply_stops', 1)
SELECT state, "check", failures::BIGINT AS failures, failures = 0 AS passed FROM g""")
def fact_gate_states(r: Relations) -> DataFrame:
    """The gate of a committed fact, and of the same fact with a row of an open day, an old, lagging or pending watermark, and a file added to a committed day."""
    pipeline, files, cutoff, last = _cycled(r, "gate")
    entity = pipeline.entity

    def told(state: str, table: DataFrame, cutoff: date = cutoff, reference: date = last, marks: DataFrame | None = None) -> DataFrame:
        marks = pipeline.watermarks.table.read() if marks is None else marks
        checks = quality.fact_gate(marks, entity, cutoff, reference, table, DAY, pipeline.manifest.states(cutoff))
        return checks.select(F.lit(state).alias("state"), "check", "failures", "passed")

    now, marks = pipeline.target.read(), pipeline.watermarks.table.read()
    frames = [
        told("committed", now), told("open day", now.unionByName(_user_days(r).where(F.col(DAY) == F.lit(last)).select(*now.columns))), told("old", now, reference=last + timedelta(days=2)),
        told("behind", now, marks=marks.withColumn("committed", F.date_sub("committed", 1))).where("check <> 'no_open_day'").unionByName(told("behind", now).where("check = 'no_open_day'")), told("pending", now, marks=marks.withColumn("status", F.lit("PENDING_VALIDATION"))),
    ]
    before = _stored(r, quality.union(frames), "gates")
    append_daily_parquet(_user_days(r).where(F.col(DAY) == F.lit(cutoff)), files, DAY)
    try:
        pipeline.apply()
        stopped = 0
    except MutationError:
        stopped = 1
    stops = r.spark.createDataFrame([("mutated", "apply_stops", stopped, not stopped)], "state string, check string, failures long, passed boolean")
    return before.unionByName(told("mutated", now)).unionByName(stops)


@query("maturity_repair_states", "INC10 INC11 INC13 S20", f"""WITH {SQL_USER_SNAPSHOTS}, m AS (SELECT max(day) AS d FROM usnap), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rk FROM usnap, m WHERE kind <> 'error' AND day <= d - 1)
SELECT user_id, day::VARCHAR AS day, kind, events, 'COMMITTED PENDING_VALIDATION COMMITTED REPAIR_PENDING_VALIDATION COMMITTED' AS states FROM k WHERE rk = 1""")
def maturity_repair_states(r: Relations) -> DataFrame:
    """A fact that rows of an open day have got into, after its repair, and the states its watermark went through."""
    pipeline, _, cutoff, last = _cycled(r, "repair")
    table = pipeline.watermarks.table
    pipeline.target.upsert(_user_days(r).where(F.col(DAY) == F.lit(last)), ["user_id"])
    repair_maturity(pipeline, cutoff)
    states = " ".join(table.read(v).first()["status"] for v in table.versions())  # one row a move
    return pipeline.target.read().select("user_id", F.col(DAY).cast("string").alias("day"), "kind", "events", F.lit(states).alias("states"))


@query("manifest_stage_and_promote", "PM4 PM5 PM6", """SELECT * FROM (VALUES ('staged again, same files', 'ok', 4, 1), ('staged again, more files', 'stopped', 4, 1), ('promoted, more files', 'stopped', 4, 1), ('promoted, files restored', 'ok', 5, 0), ('promoted again', 'ok', 5, 0), ('promoted again, more files', 'stopped', 5, 0)) AS t(step, outcome, committed_days, pending_days)""")
def manifest_stage_and_promote(r: Relations) -> DataFrame:
    """Retries of staging and promoting a day, with the same files and with files that have changed since."""
    days = last_days(r, 5)
    root = r.folder("manifest")
    rows = _user_days(r).where(F.col(DAY).isin(days))
    append_daily_parquet(rows, f"{root}/files", DAY)
    pipeline = assemble(r.spark, root, f"{root}/files")
    manifest, before, day = pipeline.manifest, days[-2], days[-1]
    manifest.bootstrap(before)
    manifest.stage(before, day)
    more = VersionedTable(r.spark, f"{root}/none")._fs
    path = lambda p: r.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    told = []

    def attempt(step: str, act, changed: bool) -> None:
        extra = f"{root}/files/{DAY}={day}/extra.parquet"
        if changed:  # a copy of a file of the day
            source = next(s.getPath() for s in more.listStatus(path(f"{root}/files/{DAY}={day}")) if s.getPath().getName().endswith(".parquet"))
            conf = r.spark.sparkContext._jsc.hadoopConfiguration()
            r.spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(more, source, more, path(extra), False, conf)
        try:
            act(before, day)
            outcome = "ok"
        except MutationError:
            outcome = "stopped"
        if changed:
            more.delete(path(extra), False)
        held = {x["status"]: x["count"] for x in manifest.table.read().groupBy("status").count().collect()}  # one row a status
        told.append((step, outcome, held.get("COMMITTED", 0), held.get("PENDING", 0)))

    attempt("staged again, same files", manifest.stage, False)
    attempt("staged again, more files", manifest.stage, True)
    attempt("promoted, more files", manifest.promote, True)
    attempt("promoted, files restored", manifest.promote, False)
    attempt("promoted again", manifest.promote, False)
    attempt("promoted again, more files", manifest.promote, True)
    return r.spark.createDataFrame(told, "step string, outcome string, committed_days int, pending_days int")


@query("reference_all_or_nothing", "INC15", f"""WITH {SQL_USER_SNAPSHOTS}, {SQL_PART_SNAPSHOTS}
SELECT 'parts' AS entity, (SELECT count(*) FROM psnap WHERE snapshot = (SELECT max(snapshot) FROM psnap))::BIGINT AS n, 1 AS versions, true AS stopped
UNION ALL SELECT 'users', (SELECT count(*) FROM usnap WHERE day = (SELECT max(day) FROM usnap)), 1, true""")
def reference_all_or_nothing(r: Relations) -> DataFrame:
    """Two reference tables from their newest snapshots; when one of them drifts, neither is written again."""
    registry = DriftRegistry(r.folder("references"), r.spark)
    raw = {"users": _user_days(r), "parts": r.part_snapshots.withColumnRenamed("snapshot", DAY)}
    tables = {name: VersionedTable(r.spark, r.folder(name)) for name in raw}
    keys = {"users": ["user_id"], "parts": ["part_id"]}
    for name, df in raw.items():
        registry.bootstrap(name, df, "setup", "first")
    overwrite_references(tables, raw, registry, DAY, keys)
    try:
        overwrite_references(tables, {"users": raw["users"].limit(0), "parts": raw["parts"].drop("flag")}, registry, DAY, keys)
        stopped = False
    except DriftError:
        stopped = True
    rows = [t.read().agg(F.lit(n).alias("entity"), F.count(F.lit(1)).alias("n"), F.lit(len(t.versions())).alias("versions"), F.lit(stopped).alias("stopped")) for n, t in tables.items()]
    return quality.union(rows)


#: First versions begin at the first event, later ones at a change time that is trusted up to the snapshot; boundaries that aren't in order are repaired.
ORDERED = HistoryPolicy("user_id", ("kind",), ("events",), snapshot="taken", initial="first_ts", changes="changed_at", compare="timestamp", ordered=True)
SQL_ORDERED = SQL_USER_SNAPSHOTS + """, os AS (SELECT user_id, kind, events, first_ts, (day + 1)::DATE AS taken, first_ts + to_days((events % 4 - 2)::INT) AS changed_at, md5(coalesce(kind, '<NULL>')) AS version_hash FROM usnap),
ol AS (SELECT *, lag(version_hash) OVER (PARTITION BY user_id ORDER BY taken) AS prev FROM os),
oc AS (SELECT *, CASE WHEN prev IS NULL THEN first_ts ELSE changed_at END AS stamp, CASE WHEN prev IS NULL THEN 'first_ts' ELSE 'changed_at' END AS stamp_name FROM ol WHERE prev IS NULL OR prev <> version_hash),
ob AS (SELECT *, CASE WHEN stamp <= taken::TIMESTAMP THEN stamp ELSE taken::TIMESTAMP END AS bound, CASE WHEN stamp <= taken::TIMESTAMP THEN stamp_name ELSE 'snapshot' END AS src FROM oc),
oo AS (SELECT *, coalesce(bound <= lag(bound) OVER (PARTITION BY user_id ORDER BY taken), false) AS late FROM ob),
ov AS (SELECT user_id, kind, version_hash, taken, CASE WHEN late THEN taken::TIMESTAMP ELSE bound END AS valid_from, CASE WHEN late THEN 'snapshot' ELSE src END AS valid_from_source FROM oo),
ordered AS (SELECT ov.*, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from, taken) AS valid_to, n.events FROM ov JOIN (SELECT user_id, max_by(events, taken) AS events FROM os GROUP BY user_id) n USING (user_id))"""


def _taken(r: Relations) -> DataFrame:
    """User snapshots as of the next morning, with a change time from two days before the first event to a day after."""
    shift = F.expr("make_interval(0, 0, 0, CAST(events % 4 - 2 AS INT))")
    return r.user_snapshots.select("user_id", "kind", "events", "first_ts", F.date_add("day", 1).alias("taken"), (F.col("first_ts") + shift).alias("changed_at"))


@query("scd2_backfill_ordered", "SCD3 SCD6", f"""WITH {SQL_ORDERED}
SELECT user_id, kind, events, version_hash, valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to, valid_to IS NULL AS is_current, valid_from_source, taken::VARCHAR AS source_snapshot FROM ordered""")
def scd2_backfill_ordered(r: Relations) -> DataFrame:
    return shown(backfill(_taken(r), ORDERED))


@query("scd2_boundary_sources", "SCD6", f"""WITH {SQL_ORDERED} SELECT valid_from_source, count(*)::BIGINT AS n FROM ordered GROUP BY 1""")
def scd2_boundary_sources(r: Relations) -> DataFrame:
    """How many versions begin at each kind of boundary: all three occur."""
    return backfill(_taken(r), ORDERED).groupBy("valid_from_source").agg(F.count(F.lit(1)).alias("n"))


_DAMAGES = {"key_lost": "keys_complete", "version_lost": "versions_of_snapshots", "type1_differs": "type1_on_all_versions", "closed": "current_is_last_observation", "future": "not_after_last_snapshot"}


@query("scd2_validators", "SCD13 W9", f"""WITH {SQL_PARTS}, one AS (SELECT min(part_id) AS k FROM parts WHERE part_id IN (SELECT part_id FROM parts GROUP BY 1 HAVING count(*) > 2))
SELECT * FROM (VALUES ('whole', 'none', true), {", ".join(f"('{d}', '{c}', true)" for d, c in _DAMAGES.items())}) AS t(history, "check", told)""")
def scd2_validators(r: Relations) -> DataFrame:
    """A whole history passes every validator; each damage is told by the validator for it."""
    from .relations import PARTS

    history, snapshots = r.part_versions.drop("version_key"), r.part_snapshots
    some = history.groupBy("part_id").agg(F.count(F.lit(1)).alias("n")).where("n > 2").agg(F.min("part_id").alias("k")).first()["k"]
    mine = F.col("part_id") == some
    first = history.where(mine).agg(F.min("valid_from").alias("t")).first()["t"]
    damaged = {
        "key_lost": history.where(~mine), "version_lost": history.where(~(mine & (F.col("valid_from") == F.lit(first)))),
        "type1_differs": history.withColumn("lines", F.when(mine & F.col("is_current"), F.col("lines") + 1).otherwise(F.col("lines"))),
        "closed": history.withColumn("version_hash", F.when(mine & F.col("is_current"), F.md5(F.lit("x"))).otherwise(F.col("version_hash"))),
        "future": history.withColumn("valid_from", F.when(mine & F.col("is_current"), F.timestamp_add("DAY", F.lit(9999), "valid_from")).otherwise(F.col("valid_from"))),
    }
    failed = invariants(history, PARTS).unionByName(validate_history(history, snapshots, PARTS)).where("NOT passed")
    out = [failed.agg(F.lit("whole").alias("history"), F.lit("none").alias("check"), (F.count(F.lit(1)) == 0).alias("told"))]
    for name, df in damaged.items():
        checks = validate_history(df, snapshots, PARTS).where(F.col("check") == _DAMAGES[name])
        out.append(checks.select(F.lit(name).alias("history"), "check", (~F.col("passed")).alias("told")))
    return quality.union(out)


@query("scd2_late_boundary_step", "SCD6 SCD8", f"""WITH {SQL_ORDERED} SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right""")
def scd2_late_boundary_step(r: Relations) -> DataFrame:
    """One more snapshot day applied to a history with trusted change times, some of which would fall before the version they close: the step repairs them as the backfill does."""
    taken = _taken(r)
    day = taken.agg(F.max("taken").alias("d")).first()["d"]
    # steps have no way to know of an order that was already repaired, so one closed version a key is taken
    two = taken.join(taken.where(F.col("taken") == F.lit(day)).select("user_id"), "user_id", "left_semi")
    before = two.where(F.col("taken") < F.lit(day)).groupBy("user_id").agg(F.max("taken").alias("taken"))
    two = two.join(before, ["user_id", "taken"], "left_semi").unionByName(two.where(F.col("taken") == F.lit(day)))
    return multiset_difference(apply_snapshot(backfill(two.where(F.col("taken") < F.lit(day)), ORDERED), two, ORDERED, day), backfill(two, ORDERED))
