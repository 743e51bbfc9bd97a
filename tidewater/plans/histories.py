"""Histories: backfill, incremental steps, validators and snapshot profiles as queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hashed
from ..operators import profile
from ..operators.history import TECHNICAL, apply_snapshot, backfill, change_points, classify_snapshot, invariants, replay_days, spread_type1
from ..operators.state import duplicates, multiset_difference
from ..sources.store import VersionedTable
from .registry import query
from .relations import PARTS, SQL_PART_SNAPSHOTS, SQL_PARTS, SQL_USER_SNAPSHOTS, SQL_USERS, USERS, Relations

text = lambda c: F.col(c).cast("string").alias(c)


def shown(history: DataFrame) -> DataFrame:
    return history.select(*[text(c) if t in ("timestamp", "date") else F.col(c) for c, t in history.dtypes])


@query("scd2_backfill_parts", "SCD1 SCD5 W2 W3", f"""WITH {SQL_PARTS}
SELECT part_id, flag, status, lines, version_hash, valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to, is_current, 'snapshot' AS valid_from_source, source_snapshot::VARCHAR AS source_snapshot FROM parts""")
def scd2_backfill_parts(r: Relations) -> DataFrame:
    return shown(r.part_versions.drop("version_key"))


@query("scd2_backfill_users", "SCD4 SCD5", f"""WITH {SQL_USERS}
SELECT user_id, kind, events, version_hash, valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to, valid_to IS NULL AS is_current, valid_from_source, source_snapshot::VARCHAR AS source_snapshot FROM users""")
def scd2_backfill_users(r: Relations) -> DataFrame:
    return shown(r.user_versions.drop("version_key"))


def last_days(r: Relations, n: int) -> list:
    days = sorted(x["day"] for x in r.user_snapshots.select("day").distinct().collect())  # one row a calendar day
    return days[-n:]


@query("scd2_incremental_equals_backfill", "SCD7 SCD8 SCD9 SCD10 SCD12 O6", "SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right")
def scd2_incremental(r: Relations) -> DataFrame:
    raw, table = VersionedTable(r.spark, r.folder("snapshots")), VersionedTable(r.spark, r.folder("history"))

    def stored(to: VersionedTable, df: DataFrame) -> DataFrame:
        return to.read(to.overwrite(df))

    snapshots, days = stored(raw, r.user_snapshots), last_days(r, 3)
    start = stored(table, backfill(snapshots.where(F.col("day") < F.lit(days[0])), USERS))
    stepped = replay_days(start, snapshots, USERS, days, lambda df: stored(table, df))
    return multiset_difference(stepped, backfill(snapshots, USERS))


@query("scd2_every_day_equals_backfill", "SCD7 SCD8 SCD9 SCD10 SCD12 O6", "SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right")
def scd2_every_day(r: Relations) -> DataFrame:
    """From the first of ten days on, every later day is a step: keys appear, change, go and come back on the way."""
    raw, table = VersionedTable(r.spark, r.folder("snapshots")), VersionedTable(r.spark, r.folder("history"))

    def stored(to: VersionedTable, df: DataFrame) -> DataFrame:
        return to.read(to.overwrite(df))

    days = last_days(r, 10)
    snapshots = stored(raw, r.user_snapshots.where(F.col("day").isin(days)))
    start = stored(table, backfill(snapshots.where(F.col("day") == F.lit(days[0])), USERS))
    return multiset_difference(replay_days(start, snapshots, USERS, days[1:], lambda df: stored(table, df)), backfill(snapshots, USERS))


@query("scd2_replay_is_idempotent", "PR14 SCD9 O6", "SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right")
def scd2_replay(r: Relations) -> DataFrame:
    full = backfill(r.user_snapshots, USERS)
    return multiset_difference(apply_snapshot(full, r.user_snapshots, USERS, last_days(r, 1)[0]), full)


@query("scd2_type1_spread", "SCD10 W1", f"""WITH {SQL_PARTS}, m AS (SELECT max(snapshot) AS top FROM psnap)
SELECT part_id, valid_from::VARCHAR AS valid_from, CASE WHEN part_id IN (SELECT part_id FROM psnap, m WHERE snapshot = top) THEN CASE WHEN part_id % 2 = 0 THEN NULL ELSE -1 END ELSE lines END::BIGINT AS lines FROM parts""")
def scd2_type1_spread(r: Relations) -> DataFrame:
    snaps = r.part_snapshots
    newest = snaps.join(F.broadcast(snaps.agg(F.max("snapshot").alias("snapshot"))), "snapshot", "left_semi")
    rows = newest.select("part_id", F.when(F.col("part_id") % 2 != 0, F.lit(-1)).cast("long").alias("lines"))
    return spread_type1(r.part_versions, rows, PARTS).select("part_id", text("valid_from"), "lines")


CHECKS = ["null_key", "null_valid_from", "null_is_current", "null_hash", "hash_of_type2", "empty_interval", "current_is_open", "one_current", "continuous", "no_redundant_version", "unique_version", "known_source"]


@query("scd2_invariants", "SCD13 W9 A3 QG3", f"""WITH {SQL_PARTS}, w AS (SELECT *, lead(valid_from) OVER p AS nxt, lag(version_hash) OVER p AS ph, count(*) FILTER (is_current) OVER (PARTITION BY part_id) AS act, count(*) OVER (PARTITION BY part_id, valid_from) AS same FROM parts WINDOW p AS (PARTITION BY part_id ORDER BY valid_from)),
s AS (SELECT count(*) FILTER (part_id IS NULL) AS null_key, count(*) FILTER (valid_from IS NULL) AS null_valid_from, count(*) FILTER (is_current IS NULL) AS null_is_current, count(*) FILTER (version_hash IS NULL) AS null_hash,
  count(*) FILTER (version_hash <> md5(concat_ws('||', coalesce(flag, '<NULL>'), coalesce(status, '<NULL>')))) AS hash_of_type2, count(*) FILTER (valid_to <= valid_from) AS empty_interval, count(*) FILTER (is_current <> (valid_to IS NULL)) AS current_is_open,
  count(*) FILTER (act <> 1) AS one_current, count(*) FILTER (valid_to IS DISTINCT FROM nxt) AS continuous, count(*) FILTER (ph = version_hash) AS no_redundant_version, count(*) FILTER (same > 1) AS unique_version, 0::BIGINT AS known_source FROM w)
SELECT "check", failures, failures = 0 AS passed FROM s UNPIVOT (failures FOR "check" IN ({', '.join(CHECKS)}))""")
def scd2_invariants(r: Relations) -> DataFrame:
    return invariants(r.part_versions.select(*PARTS.columns, *TECHNICAL), PARTS)


SQL_DAYS = "dn AS (SELECT DISTINCT day FROM usnap), dr AS (SELECT day, dense_rank() OVER (ORDER BY day) AS num FROM dn)"


@query("scd2_reappearance", "PR5 W7 J15", f"""WITH {SQL_USER_SNAPSHOTS}, {SQL_DAYS}, s AS (SELECT usnap.*, num, lag(num) OVER w AS n0, lag(kind) OVER w AS k0, lag(events) OVER w AS e0 FROM usnap JOIN dr USING (day) WINDOW w AS (PARTITION BY user_id ORDER BY day))
SELECT user_id, day::VARCHAR AS day, (num - n0 - 1)::BIGINT AS absent, k0 <> kind AS type2_changed, e0 <> events AS type1_changed FROM s WHERE num - n0 > 1""")
def scd2_reappearance(r: Relations) -> DataFrame:
    return profile.reappearances(r.user_snapshots, "user_id", "day", ["kind"], ["events"]).withColumn("day", F.col("day").cast("string"))


@query("scd2_change_attribution", "PR2 W8", f"""WITH {SQL_PART_SNAPSHOTS}, s AS (SELECT part_id, concat_ws('+', CASE WHEN flag IS DISTINCT FROM lag(flag) OVER w THEN 'flag' END, CASE WHEN status IS DISTINCT FROM lag(status) OVER w THEN 'status' END, CASE WHEN lines IS DISTINCT FROM lag(lines) OVER w THEN 'lines' END) AS signature,
  row_number() OVER w AS nth FROM psnap WINDOW w AS (PARTITION BY part_id ORDER BY snapshot))
SELECT signature, count(*)::BIGINT AS changes, count(DISTINCT part_id)::BIGINT AS keys FROM s WHERE nth > 1 AND signature <> '' GROUP BY signature""")
def scd2_change_attribution(r: Relations) -> DataFrame:
    return profile.change_signatures(r.part_snapshots, "part_id", "snapshot", ["flag", "status", "lines"])


@query("snapshot_gap_ids", "PR1 W6", f"""WITH {SQL_USER_SNAPSHOTS}, {SQL_DAYS}
SELECT user_id, min(day)::VARCHAR AS first, max(day)::VARCHAR AS last, count(*)::BIGINT AS seen, (max(num) - min(num) + 1 - count(*))::BIGINT AS missed FROM usnap JOIN dr USING (day) GROUP BY user_id""")
def snapshot_gap_ids(r: Relations) -> DataFrame:
    return profile.gaps(r.user_snapshots, "user_id", "day").select("user_id", text("first"), text("last"), "seen", "missed")


@query("snapshot_profile", "PR1 A4 A5 W11", """WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events), p AS (SELECT user_id, day, count(*) AS n, count(DISTINCT event_type) AS p FROM s GROUP BY ALL)
SELECT count(DISTINCT day)::BIGINT AS days, sum(n)::BIGINT AS rows, count(DISTINCT user_id)::BIGINT AS keys, coalesce(sum(n) FILTER (user_id IS NULL), 0)::BIGINT AS null_keys, count(*) FILTER (n > 1) AS repeated, count(*) FILTER (p > 1) AS conflicting FROM p""")
def snapshot_profile(r: Relations) -> DataFrame:
    return profile.snapshot_profile(r.table("events").withColumn("day", F.to_date("ts")), "user_id", "day", F.col("event_type"))


@query("snapshot_delta_classes", "SCD7 PR6 J8 J14", f"""WITH {SQL_USER_SNAPSHOTS}, {SQL_DAYS}, s AS (SELECT user_id, num, kind, lag(num) OVER w AS n0, lag(kind) OVER w AS k0, lead(num) OVER w AS n1 FROM usnap JOIN dr USING (day) WINDOW w AS (PARTITION BY user_id ORDER BY num)),
h AS (SELECT num, count(*) FILTER (n0 IS DISTINCT FROM num - 1) AS added, count(*) FILTER (n0 = num - 1 AND kind = k0) AS unchanged, count(*) FILTER (n0 = num - 1 AND kind <> k0) AS changed FROM s GROUP BY num),
g AS (SELECT num + 1 AS num, count(*) AS missing FROM s WHERE n1 IS DISTINCT FROM num + 1 GROUP BY ALL)
SELECT day::VARCHAR AS day, added, unchanged, changed, coalesce(missing, 0)::BIGINT AS missing FROM h LEFT JOIN g USING (num) JOIN dr USING (num)""")
def snapshot_delta_classes(r: Relations) -> DataFrame:
    return profile.day_deltas(r.user_snapshots, "user_id", "day", hashed("kind")).withColumn("day", F.col("day").cast("string"))


@query("snapshot_classes_last_day", "SCD7 J14 J15", f"""WITH {SQL_USER_SNAPSHOTS}, m AS (SELECT max(day) AS d FROM usnap), pr AS (SELECT max(day) AS p FROM usnap, m WHERE day < d),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rk FROM usnap, m WHERE day < d) WHERE rk = 1), t AS (SELECT usnap.* FROM usnap, m WHERE day = d),
j AS (SELECT coalesce(t.user_id, o.user_id) AS user_id, CASE WHEN t.user_id IS NULL THEN 'gone' WHEN o.user_id IS NULL THEN 'new' WHEN t.kind <> o.kind THEN 'type2' WHEN t.events <> o.events THEN 'type1' ELSE 'unchanged' END AS class, o.day AS seen, p FROM t FULL JOIN o USING (user_id), pr)
SELECT class, count(*)::BIGINT AS n, count(*) FILTER (class <> 'gone' AND seen < p) AS reappeared FROM j WHERE class <> 'gone' OR seen = p GROUP BY class""")
def snapshot_classes(r: Relations) -> DataFrame:
    found = classify_snapshot(r.user_snapshots, USERS, last_days(r, 1)[0])
    return found.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_if("reappeared").alias("reappeared"))


@query("payload_churn", "PR6 W8 SCD1", f"""WITH {SQL_PART_SNAPSHOTS}, {SQL_USER_SNAPSHOTS}, p AS (SELECT md5(concat_ws('||', flag, lines::VARCHAR, status)) AS h, lag(md5(concat_ws('||', flag, lines::VARCHAR, status))) OVER (PARTITION BY part_id ORDER BY snapshot) AS g FROM psnap),
u AS (SELECT md5(concat_ws('||', events::VARCHAR, first_ts::VARCHAR, kind)) AS h, lag(md5(concat_ws('||', events::VARCHAR, first_ts::VARCHAR, kind))) OVER (PARTITION BY user_id ORDER BY day) AS g FROM usnap)
SELECT 'parts' AS entity, count(*)::BIGINT AS snapshots, count(*) FILTER (g <> h) AS changes FROM p UNION ALL SELECT 'users', count(*), count(*) FILTER (g <> h) FROM u""")
def payload_churn(r: Relations) -> DataFrame:
    from pyspark.sql import Window

    from ..functions.keys import payload_hash

    def churn(df: DataFrame, name: str, key: str, day: str) -> DataFrame:
        h = df.select(key, day, payload_hash(df, (key, day)).alias("h")).withColumn("g", F.lag("h").over(Window.partitionBy(key).orderBy(day)))
        return h.agg(F.lit(name).alias("entity"), F.count(F.lit(1)).alias("snapshots"), F.count_if(F.col("g") != F.col("h")).alias("changes"))

    return churn(r.part_snapshots, "parts", "part_id", "snapshot").unionByName(churn(r.user_snapshots, "users", "user_id", "day"))


@query("first_version_boundaries", "W10 PR13 A6", f"""WITH {SQL_USERS}, f AS (SELECT user_id, min(valid_from) AS v FROM users GROUP BY user_id)
SELECT CAST(v AS DATE)::VARCHAR AS day, count(*)::BIGINT AS keys FROM f GROUP BY ALL""")
def first_version_boundaries(r: Relations) -> DataFrame:
    first = r.user_versions.groupBy("user_id").agg(F.min("valid_from").alias("v"))
    return first.groupBy(F.to_date("v").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("keys"))


@query("change_point_days", "W2 A12 O2", f"""WITH {SQL_USERS} SELECT source_snapshot::VARCHAR AS day, count(*)::BIGINT AS versions FROM users GROUP BY ALL ORDER BY versions DESC, day LIMIT 10""")
def change_point_days(r: Relations) -> DataFrame:
    points = change_points(r.user_snapshots, USERS)
    return points.groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("versions")).orderBy(F.desc("versions"), "day").limit(10)


@query("source_stability", "PR10 J8", f"""WITH {SQL_USER_SNAPSHOTS}, m AS (SELECT max(day) - 7 AS d FROM usnap), s AS (SELECT DISTINCT user_id FROM usnap), f AS (SELECT user_id, min(day) AS first FROM usnap WHERE user_id % 5 <> 0 GROUP BY user_id)
SELECT count(*) FILTER (s.user_id IS NOT NULL AND f.user_id IS NULL) AS gone_from_raw, count(*) FILTER (first > d) AS only_later, count(*) FILTER (s.user_id IS NOT NULL AND f.user_id IS NOT NULL AND first <= d) AS covered FROM s FULL JOIN f USING (user_id), m""")
def source_stability(r: Relations) -> DataFrame:
    until = last_days(r, 1)[0] - timedelta(days=7)
    return profile.coverage(r.user_snapshots, r.user_snapshots.where("user_id % 5 <> 0"), "user_id", "day", until)


@query("attribute_profile", "PR3 PR4 W8 A4", f"""WITH {SQL_USER_SNAPSHOTS}, s AS (SELECT user_id, day = (SELECT max(day) FROM usnap) AS now, kind, events, lag(day) OVER w AS d0, lag(kind) OVER w AS k0, lag(events) OVER w AS e0 FROM usnap WINDOW w AS (PARTITION BY user_id ORDER BY day)),
a AS (SELECT user_id, now, 'kind' AS attribute, kind AS value, d0 IS NOT NULL AND kind IS DISTINCT FROM k0 AS changed FROM s UNION ALL SELECT user_id, now, 'events', events::VARCHAR, d0 IS NOT NULL AND events IS DISTINCT FROM e0 FROM s)
SELECT attribute, count(*) FILTER (now AND value IS NULL) AS nulls, count(DISTINCT value) FILTER (now) AS distincts, count(*) FILTER (changed) AS changes, count(DISTINCT user_id) FILTER (changed) AS keys FROM a GROUP BY attribute""")
def attribute_profile(r: Relations) -> DataFrame:
    return profile.attribute_profile(r.user_snapshots, "user_id", "day", ["kind", "events"])


@query("contamination_by_open_days", "PR7", f"""WITH {SQL_USER_SNAPSHOTS}, m AS (SELECT max(day) - 3 AS d FROM usnap), p AS (SELECT user_id, max(day) AS day, max_by(kind || '|' || events, day) AS now, max_by(kind || '|' || events, day) FILTER (day <= d) AS closed FROM usnap, m GROUP BY user_id)
SELECT day::VARCHAR AS day, count(*) AS rows, count(*) FILTER (closed IS NULL) AS only_open, count(*) FILTER (closed <> now) AS changed, count(*) FILTER (closed = now) AS same FROM p, m WHERE day > d GROUP BY ALL""")
def contamination_by_open_days(r: Relations) -> DataFrame:
    until = last_days(r, 1)[0] - timedelta(days=3)
    return profile.contamination(r.user_snapshots, "user_id", "day", until, hashed("kind", "events")).withColumn("day", F.col("day").cast("string"))


@query("lag_percentiles", "PR8 PR9 A6", """WITH f AS (SELECT CAST(ts AS DATE) AS day, (event_id * 7 % 5)::INT AS lag FROM events)
SELECT day::VARCHAR AS day, count(*)::BIGINT AS files, min(lag) AS min_lag, quantile_disc(lag, 0.5)::INT AS median_lag, max(lag) AS max_lag, count(*) FILTER (lag > 1) AS late_files FROM f GROUP BY day""")
def lag_percentiles(r: Relations) -> DataFrame:
    files = r.table("events").select(F.to_date("ts").alias("day"), F.date_add(F.to_date("ts"), (F.col("event_id") * 7 % 5).cast("int")).cast("timestamp").alias("modified_at"))
    return profile.file_lags(files).withColumn("day", F.col("day").cast("string"))


@query("doc_number_reuse", "QG6 A2", """SELECT l_orderkey AS order_id, l_linenumber AS line, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def doc_number_reuse(r: Relations) -> DataFrame:
    return duplicates(r.lines, ["order_id", "line"])
