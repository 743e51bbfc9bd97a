"""Upserts, batch validation, maturity, manifests and repairs as queries, over event days as snapshots."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import set_fingerprint
from ..operators import incremental, manifest, state
from .histories import last_days
from .registry import query
from .relations import SQL_USER_SNAPSHOTS, Relations

SQL_TWO_DAYS = f"{SQL_USER_SNAPSHOTS}, m AS (SELECT max(day) AS d FROM usnap)"


def _user_days(r: Relations) -> DataFrame:
    return r.user_snapshots.select("user_id", "day", "kind", "events")


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.col("day").cast("string"))


def _last_day(r: Relations) -> date:
    return last_days(r, 1)[0]


@query("upsert_snapshot", "INC3 INC16 J8", f"""WITH {SQL_TWO_DAYS}, o AS (SELECT * FROM (SELECT usnap.*, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rk FROM usnap, m WHERE day < d) WHERE rk = 1), t AS (SELECT usnap.* FROM usnap, m WHERE day = d)
SELECT user_id, day::VARCHAR AS day, kind, events FROM t UNION ALL SELECT user_id, day::VARCHAR, kind, events FROM o WHERE user_id NOT IN (SELECT user_id FROM t)""")
def upsert_snapshot(r: Relations) -> DataFrame:
    days, last = _user_days(r), _last_day(r)
    held = state.latest(days.where(F.col("day") < F.lit(last)), ["user_id"], "day")
    return _shown(state.upsert(held, days.where(F.col("day") == F.lit(last)), ["user_id"]))


SQL_SIDES = f"""{SQL_USER_SNAPSHOTS}, w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS up, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS down FROM usnap),
tgt AS (SELECT user_id, day, kind, events FROM w WHERE down = 2 AND user_id % 3 <> 0), src AS (SELECT user_id, day, kind, events FROM w WHERE (user_id % 2 = 0 AND down = 1) OR (user_id % 2 = 1 AND up = 1))"""


def _sides(r: Relations) -> tuple[DataFrame, DataFrame]:
    from pyspark.sql import Window

    key = Window.partitionBy("user_id")
    w = _user_days(r).withColumn("up", F.row_number().over(key.orderBy("day"))).withColumn("down", F.row_number().over(key.orderBy(F.desc("day"))))
    even = F.col("user_id") % 2 == 0
    return w.where("down = 2 AND user_id % 3 <> 0").drop("up", "down"), w.where((even & (F.col("down") == 1)) | (~even & (F.col("up") == 1))).drop("up", "down")


@query("upsert_newest_wins", "INC4 INC14", f"""WITH {SQL_SIDES}, a AS (SELECT *, 1 AS side FROM tgt UNION ALL SELECT *, 0 FROM src), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC, side DESC) AS rk FROM a)
SELECT user_id, day::VARCHAR AS day, kind, events FROM k WHERE rk = 1""")
def upsert_newest(r: Relations) -> DataFrame:
    target, source = _sides(r)
    return _shown(state.upsert_newest(target, source, ["user_id"], "day"))


@query("merge_classification", "INC5", f"""WITH {SQL_SIDES}
SELECT CASE WHEN tgt.user_id IS NULL THEN 'insert' WHEN src.day > tgt.day THEN 'update' ELSE 'noop' END AS action, count(*)::BIGINT AS n FROM src LEFT JOIN tgt USING (user_id) GROUP BY ALL""")
def merge_classification(r: Relations) -> DataFrame:
    target, source = _sides(r)
    return state.classify(target, source, ["user_id"], "day").groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("batch_validate_diff", "INC6 INC7 INC13 A3 J8 J10 J11", f"""WITH {SQL_USER_SNAPSHOTS}, e AS (SELECT user_id, day, kind, events FROM usnap), a AS (SELECT user_id, day, CASE WHEN events % 7 = 0 THEN NULL ELSE kind END AS kind, events + (user_id % 4 = 0)::BIGINT AS events FROM usnap WHERE user_id % 5 <> 1 UNION ALL SELECT user_id, day + 1000, kind, events FROM usnap WHERE user_id % 9 = 2 UNION ALL SELECT user_id, day, kind, events FROM usnap WHERE user_id % 5 = 2),
j AS (SELECT e.user_id AS eu, a.user_id AS au, e.kind IS DISTINCT FROM a.kind AS k, e.events IS DISTINCT FROM a.events AS v FROM e FULL JOIN a ON e.user_id = a.user_id AND e.day = a.day),
s AS (SELECT (SELECT count(*) FROM (SELECT user_id, day FROM a GROUP BY ALL HAVING count(*) > 1)) AS du, count(*) FILTER (au IS NULL) AS mi, count(*) FILTER (eu IS NULL) AS ex, count(*) FILTER (eu IS NOT NULL AND au IS NOT NULL AND (k OR v)) AS mm, count(*) FILTER (eu IS NOT NULL AND au IS NOT NULL AND k) AS mk, count(*) FILTER (eu IS NOT NULL AND au IS NOT NULL AND v) AS mv FROM j)
SELECT unnest(['duplicate', 'missing', 'extra', 'mismatched', 'mismatched:kind', 'mismatched:events']) AS "check", unnest([du, mi, ex, mm, mk, mv])::BIGINT AS failures, unnest([du = 0, mi = 0, ex = 0, mm = 0, mk = 0, mv = 0]) AS passed FROM s""")
def batch_validate_diff(r: Relations) -> DataFrame:
    expected = _user_days(r)
    off = expected.where("user_id % 5 <> 1").withColumn("kind", F.when(F.col("events") % 7 != 0, F.col("kind"))).withColumn("events", F.col("events") + (F.col("user_id") % 4 == 0).cast("long"))
    more = expected.where("user_id % 9 = 2").withColumn("day", F.date_add("day", 1000))
    return state.compare_batch(expected, off.unionByName(more).unionByName(expected.where("user_id % 5 = 2")), ["user_id", "day"], extra_allowed=False)


SQL_MTIME = """fi AS (SELECT CAST(ts AS DATE) AS day, event_id, CAST(ts AS DATE) + CASE WHEN day(ts) IN (3, 11) OR CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) - 2 FROM events) THEN (event_id % 2)::INT ELSE 1 + (event_id % 3)::INT END AS modified FROM events)"""


def _files(r: Relations) -> DataFrame:
    e = r.table("events").select(F.to_date("ts").alias("day"), "event_id")
    late = F.col("day") >= F.date_sub(F.lit(_last_day(r)), 2)
    lag = F.when(F.dayofmonth("day").isin(3, 11) | late, F.col("event_id") % 2).otherwise(1 + F.col("event_id") % 3)
    return e.select("day", "event_id", F.date_add("day", lag.cast("int")).cast("timestamp").alias("modified_at"))


@query("maturity_cutoff", "INC1 A13", f"""WITH {SQL_MTIME}, d AS (SELECT day, min(modified) AS first FROM fi GROUP BY day) SELECT max(day)::VARCHAR AS cutoff FROM d WHERE first > day""")
def maturity(r: Relations) -> DataFrame:
    return incremental.maturity_cutoff(_files(r)).select(F.col("cutoff").cast("string").alias("cutoff"))


@query("watermark_range", "P7", f"""WITH {SQL_USER_SNAPSHOTS}, m AS (SELECT max(day) AS d FROM usnap)
SELECT 'bounded' AS case_name, count(*)::BIGINT AS n, min(day)::VARCHAR AS first, max(day)::VARCHAR AS last FROM usnap, m WHERE day > d - 9 AND day <= d - 2
UNION ALL SELECT 'no lower bound', count(*), min(day)::VARCHAR, max(day)::VARCHAR FROM usnap, m WHERE day <= d - 2 UNION ALL SELECT 'nothing closed', 0, NULL, NULL""")
def watermark_range(r: Relations) -> DataFrame:
    last, out = _last_day(r), None
    for name, committed, cutoff in (("bounded", last - timedelta(days=9), last - timedelta(days=2)), ("no lower bound", None, last - timedelta(days=2)), ("nothing closed", last, None)):
        one = incremental.pending_range(_user_days(r), "day", committed, cutoff).agg(F.lit(name).alias("case_name"), F.count(F.lit(1)).alias("n"), F.min("day").cast("string").alias("first"), F.max("day").cast("string").alias("last"))
        out = one if out is None else out.unionByName(one)
    return out


@query("manifest_compare", "PM1 PM2 J10 A9", """WITH k AS (SELECT CAST(ts AS DATE) AS day, event_id FROM events WHERE day(ts) <> 5), o AS (SELECT CAST(ts AS DATE) AS day, event_id FROM events WHERE day(ts) <> 9 AND NOT (day(ts) = 7 AND event_id % 10 = 0)),
f AS (SELECT day, sha256(array_to_string(list_sort(list(DISTINCT concat('f', event_id, '::', event_id * 7))), '||')) AS fp FROM k GROUP BY day), g AS (SELECT day, sha256(array_to_string(list_sort(list(DISTINCT concat('f', event_id, '::', event_id * 7))), '||')) AS fp FROM o GROUP BY day)
SELECT day::VARCHAR AS day, CASE WHEN g.fp IS NULL THEN 'missing' WHEN f.fp IS NULL THEN 'extra' WHEN f.fp <> g.fp THEN 'changed' ELSE 'same' END AS state FROM f FULL JOIN g USING (day)""")
def manifest_compare(r: Relations) -> DataFrame:
    files = r.table("events").select(F.to_date("ts").alias("day"), "event_id", F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("path"), (F.col("event_id") * 7).alias("at"))
    prints = lambda df: df.groupBy("day").agg(set_fingerprint("path", "at").alias("fingerprint"))
    number = F.dayofmonth("day")
    known, now = files.where(number != 5), files.where((number != 9) & ~((number == 7) & (F.col("event_id") % 10 == 0)))
    return _shown(manifest.compare(prints(known), prints(now)))


SQL_CONTAMINATED = f"""{SQL_USER_SNAPSHOTS}, m AS (SELECT max(day) - 2 AS cut FROM usnap), top AS (SELECT user_id, day, kind, events FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rk FROM usnap) WHERE rk = 1),
old AS (SELECT user_id, day, kind, events FROM (SELECT usnap.*, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS rk FROM usnap, m WHERE day <= cut) WHERE rk = 1)"""


def _top(r: Relations) -> DataFrame:
    return state.latest(_user_days(r), ["user_id"], "day")


@query("repair_restore_only_contaminated", "INC12 J9 S20", f"""WITH {SQL_CONTAMINATED} SELECT user_id, day::VARCHAR AS day, kind, events FROM top, m WHERE day <= cut UNION ALL SELECT user_id, day::VARCHAR, kind, events FROM old WHERE user_id IN (SELECT user_id FROM top, m WHERE day > cut)""")
def repair_restore(r: Relations) -> DataFrame:
    return _shown(incremental.restore_contaminated(_top(r), _user_days(r), ["user_id"], "day", _last_day(r) - timedelta(days=2)))


@query("repair_replay_window", "INC11 S20", f"""WITH {SQL_CONTAMINATED}, re AS (SELECT old.* FROM old, m WHERE day > cut - 5), u AS (SELECT * FROM re UNION ALL SELECT * FROM top WHERE user_id NOT IN (SELECT user_id FROM re)) SELECT user_id, day::VARCHAR AS day, kind, events FROM u, m WHERE day <= cut""")
def repair_replay(r: Relations) -> DataFrame:
    cutoff = _last_day(r) - timedelta(days=2)
    rebuilt = state.latest(incremental.pending_range(_user_days(r), "day", cutoff - timedelta(days=5), cutoff), ["user_id"], "day")
    return _shown(incremental.repair_open_days(_top(r), rebuilt, ["user_id"], "day", cutoff))


@query("repair_union_daily_wins", "INC14 O5 O6", f"""WITH {SQL_USER_SNAPSHOTS}, da AS (SELECT user_id, day, kind, events FROM usnap WHERE day(day) > 10), ba AS (SELECT user_id, day, 'backfill' AS kind, events FROM usnap WHERE day(day) <= 12)
SELECT user_id, day::VARCHAR AS day, kind, events, 'daily' AS origin FROM da UNION ALL SELECT user_id, day::VARCHAR, kind, events, 'backfill' FROM ba WHERE NOT EXISTS (SELECT 1 FROM da WHERE da.user_id = ba.user_id AND da.day = ba.day)""")
def repair_union(r: Relations) -> DataFrame:
    number = F.dayofmonth("day")
    old = _user_days(r).where(number <= 12).withColumn("kind", F.lit("backfill")).select("events", "kind", "day", "user_id")
    return _shown(incremental.merge_backfill(_user_days(r).where(number > 10), old, ["user_id"], "day"))


@query("reference_latest_snapshot", "W1", f"""WITH {SQL_USER_SNAPSHOTS} SELECT user_id, day::VARCHAR AS day, kind, events FROM usnap WHERE day = (SELECT max(day) FROM usnap)""")
def reference_latest(r: Relations) -> DataFrame:
    return _shown(incremental.newest_snapshot(_user_days(r), "day"))
