"""Quality gates as DataFrames of (check, failures, passed, detail), and their enforcement."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .history import as_checks


class GateError(RuntimeError):
    pass


def union(checks: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, checks)


def named(name: str, failures: DataFrame) -> DataFrame:
    """One check that fails by the rows of ``failures``."""
    return failures.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("failures"), (F.count(F.lit(1)) == 0).alias("passed"))


def row_checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return as_checks(df, rules)


def unique(df: DataFrame, *keys: str, name: str | None = None) -> DataFrame:
    """Keys that are there more than once; null keys don't count."""
    known = df.where(functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return named(name or f"unique:{','.join(keys)}", known.groupBy(*keys).count().where("count > 1"))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return as_checks(df, {f"not_null:{c}": F.col(c).isNull() for c in columns})


def accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list; null passes."""
    return as_checks(df, {f"accepted_values:{column}": F.coalesce(~F.col(column).isin(*values), F.lit(False))})


def relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str | None = None) -> DataFrame:
    """Rows whose key has no parent; null passes."""
    keys = parent.select(F.col(parent_column).alias("_p")).distinct()
    return named(name or f"relationship:{column}", child.where(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_p"), "left_anti"))


def null_rate(df: DataFrame, column: str, most: float, name: str | None = None) -> DataFrame:
    """Fails once if more than ``most`` of the rows are null."""
    row = df.agg(F.count_if(F.col(column).isNull()).alias("nulls"), F.count(F.lit(1)).alias("n"))
    bad = F.col("nulls") > F.col("n") * F.lit(most).cast("decimal(10,6)")
    return row.select(F.lit(name or f"null_rate:{column}").alias("check"), F.when(bad, F.col("nulls")).otherwise(0).cast("long").alias("failures"), (~bad).alias("passed"))


def volume(built: DataFrame, source: DataFrame, least_percent: int = 99, name: str = "volume") -> DataFrame:
    """Fails by the rows that are missing if fewer than ``least_percent`` of the source's rows were built."""
    a, b = built.agg(F.count(F.lit(1)).alias("a")), source.agg(F.count(F.lit(1)).alias("b"))
    bad = F.col("a") * 100 < F.col("b") * least_percent
    return a.join(b, F.lit(True)).select(F.lit(name).alias("check"), F.when(bad, F.col("b") - F.col("a")).otherwise(0).cast("long").alias("failures"), (~bad).alias("passed"))


def fact_checks(fact: DataFrame, key: str, required: str, rules: dict[str, Column], source: DataFrame, least_percent: int = 99, most_null: float = 0.01) -> DataFrame:
    """Unique and known ``key``, row ``rules``, volume against ``source`` and the rate of nulls in ``required``: the fact is read once, grouped by its key."""
    each = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(required).isNull()).alias("_null"), *[F.count_if(c).alias(f"_rule_{i}") for i, c in enumerate(rules.values())])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    row = each.agg(
        F.count_if((F.col("_n") > 1) & F.col(key).isNotNull()).alias("_twice"), total(F.when(F.col(key).isNull(), F.col("_n"))).alias("_unknown"), total(F.col("_n")).alias("_rows"), total(F.col("_null")).alias("_null"),
        *[total(F.col(f"_rule_{i}")).alias(f"_rule_{i}") for i in range(len(rules))],
    ).join(source.agg(F.count(F.lit(1)).alias("_source")), F.lit(True))
    short, holes = F.col("_rows") * 100 < F.col("_source") * least_percent, F.col("_null") > F.col("_rows") * F.lit(most_null).cast("decimal(10,6)")
    failures = {f"unique:{key}": F.col("_twice"), f"not_null:{key}": F.col("_unknown")} | {name: F.col(f"_rule_{i}") for i, name in enumerate(rules)}
    failures |= {"volume": F.when(short, F.col("_source") - F.col("_rows")).otherwise(0), f"null_rate:{required}": F.when(holes, F.col("_null")).otherwise(0)}
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("check"), c.cast("long").alias("failures")) for n, c in failures.items()]))
    return row.select(pairs.alias("p")).select("p.check", "p.failures", (F.col("p.failures") == 0).alias("passed"))


def reconcile(eligible: DataFrame, built: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact reconciliation on the grain: missing and extra keys, by one join of the two sides."""
    a, b = eligible.select(*keys, F.lit(True).alias("_want")), built.select(*keys, F.lit(True).alias("_have"))
    return as_checks(a.join(b, list(keys), "full_outer"), {"missing": F.col("_have").isNull(), "extra": F.col("_want").isNull()})


def orphans(children: DataFrame, column: str, parents: DataFrame, raw_parents: DataFrame, parent_column: str) -> DataFrame:
    """cause, lines, parents: children without a parent, by whether the raw layer has the parent (``rejected``) or not (``not_in_source``)."""
    keys = lambda df, name: df.select(F.col(parent_column).alias(name)).distinct()
    lost = children.where(F.col(column).isNotNull()).join(keys(parents, "_p"), F.col(column) == F.col("_p"), "left_anti")
    marked = lost.join(keys(raw_parents, "_r"), F.col(column) == F.col("_r"), "left")
    cause = F.when(F.col("_r").isNull(), "not_in_source").otherwise("rejected")
    return marked.groupBy(cause.alias("cause")).agg(F.count(F.lit(1)).alias("lines"), F.countDistinct(column).alias("parents"))


def one_current(history: DataFrame, key: str) -> DataFrame:
    active = history.groupBy(key).agg(F.count_if(F.col("is_current")).alias("n"))
    return named("at_most_one_current", active.where("n > 1")).unionByName(as_checks(history, {"is_current_known": F.col("is_current").isNull()}))


def freshness(control: DataFrame, expected: DataFrame, reference, most_days: int) -> DataFrame:
    """entity, status: ok, stale, missing or unexpected, against an explicit set of what should be there. ``control``: entity, at."""
    both = expected.select(F.col("entity").alias("_e")).join(control, F.col("_e") == F.col("entity"), "full_outer")
    age = F.datediff(F.lit(reference).cast("date"), F.to_date("at"))
    status = F.when(F.col("entity").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when(F.coalesce(age > most_days, F.lit(True)), "stale").otherwise("ok")
    return both.select(F.coalesce("_e", "entity").alias("entity"), age.alias("age_days"), status.alias("status"))


def raw_gate(df: DataFrame, key: str, day_column: str, reference, most_days: int) -> DataFrame:
    """Recency, null keys, null days and repeated keys of the last day: two aggregates."""
    last = df.agg(F.max(day_column).alias("_last"))
    age = F.datediff(F.lit(reference).cast("date"), F.col("_last"))
    recency = last.select(F.lit("recency").alias("check"), F.when(F.coalesce(age > most_days, F.lit(True)), 1).otherwise(0).cast("long").alias("failures")).withColumn("passed", F.col("failures") == 0)
    newest = df.join(F.broadcast(last), F.col(day_column) == F.col("_last"))
    repeated = newest.groupBy(key).count().where(f"count > 1 AND {key} IS NOT NULL")
    return union([recency, as_checks(df, {"null_key": F.col(key).isNull(), "null_day": F.col(day_column).isNull()}), named("repeated_in_last_day", repeated)])


def fact_gate(marks: DataFrame, entity: str, cutoff, reference, table: DataFrame, day_column: str, days: DataFrame, most_days: int = 2) -> DataFrame:
    """What a committed fact keeps: one watermark, at rest, at the last closed day ``cutoff``, at most ``most_days`` old; no row of an open day; files as committed.

    ``marks``: entity, committed, status. ``days``: day, state, as the manifest compares them.
    """
    mine = marks.where(F.col("entity") == entity).agg(F.count(F.lit(1)).alias("n"), F.max("committed").alias("at"), F.min("status").alias("status"))
    age = F.datediff(F.lit(reference).cast("date"), F.col("at"))
    rules = {"single_watermark": F.col("n") != 1, "at_rest": ~F.col("status").eqNullSafe(F.lit("COMMITTED")), "at_the_last_closed_day": ~F.col("at").eqNullSafe(F.lit(cutoff).cast("date")), "fresh": F.coalesce(age > most_days, F.lit(True))}
    return union([as_checks(mine, rules), named("no_open_day", table.where(F.col(day_column) > F.lit(cutoff))), named("files_as_committed", days.where("state <> 'same'"))])


def allowlisted(df: DataFrame, columns: Sequence[str], forbidden: Sequence[str] = ()) -> DataFrame:
    """The listed columns alone; a list that names a forbidden or an absent one raises."""
    wrong = sorted({*columns} & {*forbidden}) + [c for c in columns if c not in df.columns]
    if wrong:
        raise GateError(f"columns {wrong} can't be taken")
    return df.select(*columns)


def enforce(checks: DataFrame) -> int:
    """Raises with every failed check, else the number of checks."""
    rows = checks.collect()
    failed = [f"{r['check']}: {r['failures']}" for r in rows if not r["passed"]]
    if failed:
        raise GateError("; ".join(failed))
    return len(rows)


def environment_gate(spark, required: Sequence[str], path: str) -> DataFrame:
    """Tables that must be there and a canary that must be writable under ``path`` and readable again."""
    rows = [(f"table:{t}", int(not spark.catalog.tableExists(t))) for t in required]
    spark.range(1).write.mode("overwrite").parquet(f"{path}/_canary")
    rows.append(("canary", int(spark.read.parquet(f"{path}/_canary").count() != 1)))
    return spark.createDataFrame(rows, "check string, failures long").withColumn("passed", F.col("failures") == 0)
