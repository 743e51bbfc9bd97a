"""Read-only profiles of snapshot histories and raw files."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hashed


def ranked_days(snapshots: DataFrame, day: str) -> DataFrame:
    """day, number of the snapshot days in order: one small row a day."""
    days = snapshots.select(day).distinct()
    return days.withColumn("number", F.dense_rank().over(Window.orderBy(day)))


def gaps(snapshots: DataFrame, key: str, day: str) -> DataFrame:
    """key, first, last, seen, missed: days a key was missing between its first and last."""
    numbered = snapshots.join(F.broadcast(ranked_days(snapshots, day)), day)
    out = numbered.groupBy(key).agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count(F.lit(1)).alias("seen"), (F.max("number") - F.min("number") + 1 - F.count(F.lit(1))).cast("long").alias("missed"))
    return out


def reappearances(snapshots: DataFrame, key: str, day: str, type2: Sequence[str], type1: Sequence[str] = ()) -> DataFrame:
    """Every return after an absence: how long it was, and whether type 2 or type 1 attributes changed meanwhile."""
    numbered = snapshots.join(F.broadcast(ranked_days(snapshots, day)), day)
    order = Window.partitionBy(key).orderBy(day)
    out = numbered.select(
        key, day, "number", F.lag("number").over(order).alias("_n"), F.lag(hashed(*type2)).over(order).alias("_2"), hashed(*type2).alias("_h2"),
        *([F.lag(hashed(*type1)).over(order).alias("_1"), hashed(*type1).alias("_h1")] if type1 else [F.lit("").alias("_1"), F.lit("").alias("_h1")]),
    )
    out = out.where(F.col("number") - F.col("_n") > 1)
    return out.select(key, day, (F.col("number") - F.col("_n") - 1).cast("long").alias("absent"), (F.col("_2") != F.col("_h2")).alias("type2_changed"), (F.col("_1") != F.col("_h1")).alias("type1_changed"))


def change_signatures(snapshots: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """signature (names of the attributes that changed together), changes, keys: one window for all attributes."""
    order = Window.partitionBy(key).orderBy(day)
    flags = [F.when(~F.col(c).eqNullSafe(F.lag(c).over(order)), F.lit(c)).alias(f"_{c}") for c in columns]
    marked = snapshots.select(key, F.row_number().over(order).alias("_nth"), *flags).where("_nth > 1")
    signature = F.concat_ws("+", *[f"_{c}" for c in columns])
    return marked.withColumn("signature", signature).where("signature <> ''").groupBy("signature").agg(F.count(F.lit(1)).alias("changes"), F.countDistinct(key).alias("keys"))


def day_deltas(snapshots: DataFrame, key: str, day: str, payload: Column) -> DataFrame:
    """day, added, unchanged, changed, missing against the snapshot day before, for all days in one window each way."""
    numbered = snapshots.join(F.broadcast(ranked_days(snapshots, day)), day).select(key, day, "number", payload.alias("_p"))
    order = Window.partitionBy(key).orderBy("number")
    seen = numbered.select("number", F.lag("number").over(order).alias("_n"), F.lag("_p").over(order).alias("_q"), "_p", F.lead("number").over(order).alias("_next"))
    before = F.coalesce(F.col("_n") == F.col("number") - 1, F.lit(False))
    here = seen.groupBy("number").agg(F.count_if(~before).alias("added"), F.count_if(before & (F.col("_p") == F.col("_q"))).alias("unchanged"), F.count_if(before & (F.col("_p") != F.col("_q"))).alias("changed"))
    gone = seen.where(F.coalesce(F.col("_next") != F.col("number") + 1, F.lit(True))).groupBy((F.col("number") + 1).alias("_g")).agg(F.count(F.lit(1)).alias("missing"))
    days = F.broadcast(ranked_days(snapshots, day))
    return here.join(gone, F.col("number") == F.col("_g"), "left").join(days, "number").select(day, "added", "unchanged", "changed", F.coalesce("missing", F.lit(0)).cast("long").alias("missing"))


def key_deltas(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys missing in ``before``, extra in it, with changed and with the same payload. Both have unique keys."""
    values = [c for c in before.columns if c not in keys]
    a = before.select(*[F.col(k).alias(f"_{k}") for k in keys], hashed(*values).alias("_a"))
    b = after.select(*keys, hashed(*values).alias("_b"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    both = b.join(a, functools.reduce(lambda x, y: x & y, on), "full_outer")
    return both.agg(
        F.count_if(F.col("_a").isNull()).alias("missing"), F.count_if(F.col("_b").isNull()).alias("extra"),
        F.count_if(F.coalesce(F.col("_a") != F.col("_b"), F.lit(False))).alias("changed"), F.count_if(F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))).alias("same"),
    )


def snapshot_profile(snapshots: DataFrame, key: str, day: str, payload: Column) -> DataFrame:
    """One row: days, rows, keys, null keys, repeated keys in a day, and of these the ones that conflict."""
    per = snapshots.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"), F.countDistinct(payload).alias("_p"))
    return per.agg(
        F.countDistinct(day).alias("days"), F.sum("_n").alias("rows"), F.countDistinct(key).alias("keys"), F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("_n") > 1).alias("repeated"), F.count_if(F.col("_p") > 1).alias("conflicting"),
    )


def file_lags(files: DataFrame) -> DataFrame:
    """day, files, min_lag, median_lag, max_lag in days, and the files later than the day after. ``files``: day, modified_at."""
    lag = F.datediff(F.to_date("modified_at"), F.col("day"))
    return files.withColumn("_lag", lag).groupBy("day").agg(
        F.count(F.lit(1)).alias("files"), F.min("_lag").alias("min_lag"), F.percentile_approx("_lag", 0.5, 100_000).alias("median_lag"), F.max("_lag").alias("max_lag"), F.count_if(F.col("_lag") > 1).alias("late_files")
    )


def coverage(state: DataFrame, history: DataFrame, key: str, day: str, until) -> DataFrame:
    """One row: keys of the state that raw days up to ``until`` don't have, and keys that only later days have."""
    seen = history.groupBy(key).agg(F.min(day).alias("_first"))
    both = state.select(F.col(key).alias("_k")).distinct().join(seen, F.col("_k") == F.col(key), "full_outer")
    later = F.coalesce(F.col("_first") > F.lit(until), F.lit(False))
    return both.agg(F.count_if(F.col("_k").isNotNull() & F.col(key).isNull()).alias("gone_from_raw"), F.count_if(later).alias("only_later"), F.count_if(F.col("_k").isNotNull() & ~later & F.col(key).isNotNull()).alias("covered"))


def attribute_profile(snapshots: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """attribute, nulls and distinct values on the last day, changes between a key's snapshots and keys that changed: one window and one aggregate for all attributes."""
    order = Window.partitionBy(key).orderBy(day)
    repeated = F.lag(day).over(order).isNotNull()
    marked = snapshots.select(key, day, *columns, *[(repeated & ~F.col(c).eqNullSafe(F.lag(c).over(order))).alias(f"_{c}") for c in columns])
    marked = marked.crossJoin(F.broadcast(snapshots.agg(F.max(day).alias("_last"))))
    each = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value"), F.col(f"_{c}").alias("changed")) for c in columns])
    rows = marked.select(F.col(key).alias("_k"), (F.col(day) == F.col("_last")).alias("_now"), F.inline(each))
    return rows.groupBy("attribute").agg(
        F.count_if(F.col("_now") & F.col("value").isNull()).alias("nulls"), F.countDistinct(F.when(F.col("_now"), F.col("value"))).alias("distincts"),
        F.count_if("changed").alias("changes"), F.countDistinct(F.when(F.col("changed"), F.col("_k"))).alias("keys"),
    )


def contamination(snapshots: DataFrame, key: str, day: str, until, payload: Column) -> DataFrame:
    """What days after ``until`` did to the newest state: day, rows it holds from that open day, and of these keys that no closed day has, with another and with the same payload."""
    state = F.max_by(F.struct(F.col(day).alias("day"), payload.alias("now")), F.col(day))
    closed = F.max_by(payload, F.when(F.col(day) <= F.lit(until), F.col(day)))
    per = snapshots.groupBy(key).agg(state.alias("_s"), closed.alias("_closed"), F.min(day).alias("_first"))
    late = F.col("_first") > F.lit(until)
    same = F.col("_s.now").eqNullSafe(F.col("_closed"))
    return per.where(F.col("_s.day") > F.lit(until)).groupBy(F.col("_s.day").alias(day)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("only_open"), F.count_if(~late & ~same).alias("changed"), F.count_if(~late & same).alias("same")
    )
