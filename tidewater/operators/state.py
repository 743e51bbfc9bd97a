"""Current state: latest row per key, upserts and comparisons, as pure DataFrame kernels."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions, F.lit(False))


def changed(left: str, right: str, columns: Sequence[str]) -> Column:
    """Whether any column differs between two aliases; null equals null."""
    row = lambda side: F.struct(F.lit(0), *[F.col(f"{side}.{c}") for c in columns])
    return ~row(left).eqNullSafe(row(right))


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def latest(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row of each key that is greatest by ``order``; ties go to the greatest of the other columns."""
    rest = sorted(c for c in df.columns if c not in {*keys, *order})
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*order, *rest)]))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` replace those of ``target`` with the same key; absence deletes nothing."""
    return target.alias("t").join(source.alias("s"), same_key("t", "s", keys), "left_anti").unionByName(source)


def upsert_newest(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Of equal keys the later by ``order`` stays; the target's on a tie."""
    both = target.withColumn("_side", F.lit(1)).unionByName(source.withColumn("_side", F.lit(0)))
    return latest(both, keys, order, "_side").drop("_side")


def classify(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``source`` with ``action``: insert, update (it is newer) or noop."""
    held = target.select(*keys, F.col(order).alias("_held"), F.lit(True).alias("_is"))
    joined = source.alias("s").join(held.alias("h"), same_key("s", "h", keys), "left")
    action = F.when(F.col("_is").isNull(), "insert").when(F.col(f"s.{order}") > F.col("_held"), "update").otherwise("noop")
    return joined.select("s.*", action.alias("action"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than one row with their count; null keys count as equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def compare_batch(expected: DataFrame, actual: DataFrame, keys: Sequence[str], extra_allowed: bool = True) -> DataFrame:
    """One row a check: duplicate, missing, mismatched and (unless allowed) extra keys, and a mismatch count a column. One pass over one join."""
    values = [c for c in expected.columns if c not in keys]
    e, a = expected.withColumn("_e", F.lit(1)).alias("e"), actual.withColumn("_a", F.lit(1)).alias("a")
    both = e.join(a, same_key("e", "a", keys), "full_outer")
    here = F.col("_e").isNotNull() & F.col("_a").isNotNull()
    total = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    sums = [total(F.col("_a").isNull()).alias("missing"), total(F.col("_e").isNull()).alias("extra"), total(here & changed("e", "a", values)).alias("mismatched")]
    sums += [total(here & ~F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}"))).alias(f"mismatched:{c}") for c in values]
    row = both.agg(*sums)
    twice = duplicates(actual, keys).agg(F.count(F.lit(1)).alias("duplicate"))
    row = row.join(twice, F.lit(True))
    names = ["duplicate", "missing", *([] if extra_allowed else ["extra"]), "mismatched", *(f"mismatched:{c}" for c in values)]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("failures")) for n in names]))
    return row.select(pairs.alias("p")).select("p.check", "p.failures", (F.col("p.failures") == 0).alias("passed"))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many rows each side has that the other hasn't, repeats counted; nulls equal nulls."""
    columns = left.columns
    a = left.exceptAll(right.select(*columns)).agg(F.count(F.lit(1)).alias("only_left"))
    b = right.select(*columns).exceptAll(left).agg(F.count(F.lit(1)).alias("only_right"))
    return a.join(b, F.lit(True))
