"""Executable data contracts: one aggregate validates all rules; bad rows go to quarantine with their reasons."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .state import any_of, latest

RULES = ("not_null", "no_duplicates", "referential_integrity", "freshness")
SEVERITIES = ("error", "warning")


class ContractError(ValueError):
    """The contract itself, the structure or the freshness of the data is at fault."""


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str
    nullable: bool = True
    unique: bool = False
    min: object = None
    max: object = None
    accepted_values: tuple = ()


@dataclass(frozen=True)
class Rule:
    rule: str
    severity: str = "error"
    columns: tuple[str, ...] = ()
    references: str | None = None
    max_age_hours: float | None = None


@dataclass(frozen=True)
class Contract:
    table: str
    grain: tuple[str, ...]
    columns: tuple[ColumnRule, ...]
    rules: tuple[Rule, ...] = ()
    owner: str = ""
    sla_hours: float | None = None

    @classmethod
    def from_dict(cls, spec: dict) -> Contract:
        """From parsed YAML; wrong definitions raise together."""
        wrong = [f"{k} is missing" for k in ("table", "grain", "columns") if not spec.get(k)]
        names = [c.get("name") for c in spec.get("columns") or ()]
        wrong += [f"column {n!r} is repeated" for n in {n for n in names if names.count(n) > 1}]
        wrong += [f"column {c.get('name')!r} has no type" for c in spec.get("columns") or () if not c.get("type")]
        wrong += [f"grain column {g!r} is unknown" for g in spec.get("grain") or () if g not in names]
        for r in spec.get("quality_rules") or ():
            if r.get("rule") not in RULES:
                wrong.append(f"rule {r.get('rule')!r} is unknown")
            if r.get("severity", "error") not in SEVERITIES:
                wrong.append(f"severity {r.get('severity')!r} is unknown")
            wrong += [f"rule column {c!r} is unknown" for c in r.get("columns") or () if c not in names]
            if r.get("rule") == "referential_integrity" and len(str(r.get("references") or "").split(".")) != 2:
                wrong.append("references must be table.column")
            if r.get("rule") == "freshness" and (not r.get("max_age_hours") or len(r.get("columns") or ()) != 1):
                wrong.append("freshness needs one column and max_age_hours")
        if wrong:
            raise ContractError("; ".join(wrong))
        columns = tuple(ColumnRule(c["name"], c["type"], c.get("nullable", True), c.get("unique", False), c.get("min"), c.get("max"), tuple(c.get("accepted_values") or ())) for c in spec["columns"])
        rules = tuple(Rule(r["rule"], r.get("severity", "error"), tuple(r.get("columns") or ()), r.get("references"), r.get("max_age_hours")) for r in spec.get("quality_rules") or ())
        return cls(spec["table"], tuple(spec["grain"]), columns, rules, spec.get("owner", ""), spec.get("sla_freshness_hours"))

    @classmethod
    def from_yaml(cls, path: str) -> Contract:
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f))


@dataclass
class Verdict:
    """``valid`` and ``quarantine`` (with ``reasons``) are lazy; ``report`` is one row a rule."""

    valid: DataFrame
    quarantine: DataFrame
    marked: DataFrame
    conditions: dict[str, tuple[str, Column]] = field(default_factory=dict)

    def report(self) -> DataFrame:
        """rule, severity, failures: all rules in one aggregate."""
        return _report(self.marked, self.conditions)


def _report(marked: DataFrame, conditions: dict[str, tuple[str, Column]]) -> DataFrame:
    names = list(conditions)
    row = marked.agg(*[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(f"r{i}") for i, (_, c) in enumerate(conditions.values())])
    structs = [F.struct(F.lit(n).alias("rule"), F.lit(conditions[n][0]).alias("severity"), F.col(f"r{i}").alias("failures")) for i, n in enumerate(names)]
    return row.select(F.explode(F.array(*structs)).alias("p")).select("p.rule", "p.severity", "p.failures")


def structural_errors(df: DataFrame, contract: Contract) -> list[str]:
    """Missing columns and other types; more columns are allowed."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    norm = lambda t: {"integer": "int", "long": "bigint"}.get(t.lower().replace(" ", ""), t.lower().replace(" ", ""))
    missing = [f"missing column {c.name}" for c in contract.columns if c.name not in have]
    return missing + [f"{c.name} is {have[c.name]}, not {c.type}" for c in contract.columns if c.name in have and norm(have[c.name]) != norm(c.type)]


def column_conditions(contract: Contract) -> dict[str, tuple[str, Column]]:
    """The rules implied by columns; min, max and accepted values pass null."""
    explicit = {c for r in contract.rules if r.rule == "not_null" for c in r.columns}
    out: dict[str, tuple[str, Column]] = {}
    bad = lambda c: F.coalesce(c, F.lit(False))
    for c in contract.columns:
        if not c.nullable and c.name not in explicit:
            out[f"not_null:{c.name}"] = ("error", F.col(c.name).isNull())
        if c.min is not None:
            out[f"min:{c.name}"] = ("error", bad(F.col(c.name) < F.lit(c.min)))
        if c.max is not None:
            out[f"max:{c.name}"] = ("error", bad(F.col(c.name) > F.lit(c.max)))
        if c.accepted_values:
            out[f"accepted_values:{c.name}"] = ("error", bad(~F.col(c.name).isin(*c.accepted_values)))
    return out


def validate(df: DataFrame, contract: Contract, tables: Callable[[str], DataFrame] | None = None, scope: tuple[str, ...] = (), now: datetime | None = None) -> Verdict:
    """Splits ``df`` by the contract. ``scope`` (the snapshot column in history mode) narrows what counts as a duplicate.

    All members of a duplicate are at fault, nulls count as equal. Referential integrity ignores nulls and matches the
    distinct keys of the referenced table. Structure, unknown references and freshness errors raise.
    """
    errors = structural_errors(df, contract)
    if errors:
        raise ContractError("; ".join(errors))
    conditions, marked = column_conditions(contract), df
    listed = [tuple(r.columns or contract.grain) for r in contract.rules if r.rule == "no_duplicates"]
    unique = [(f"unique:{c.name}", "error", (c.name,)) for c in contract.columns if c.unique and (c.name,) not in listed]
    unique += [(f"no_duplicates:{','.join(r.columns or contract.grain)}", r.severity, r.columns or contract.grain) for r in contract.rules if r.rule == "no_duplicates"]
    for i, (name, severity, keys) in enumerate(unique):
        # counted in each task before the exchange, so that a key of many rows, null too, isn't gathered; only repeated keys are joined back
        by = list(dict.fromkeys([*keys, *scope]))
        twice = df.groupBy(*by).agg(F.count(F.lit(1)).alias(f"_dup{i}")).where(f"_dup{i} > 1").withColumnsRenamed({c: f"_dup{i}_{c}" for c in by})
        marked = marked.join(twice, functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_dup{i}_{c}")) for c in by]), "left")
        conditions[name] = (severity, F.col(f"_dup{i}").isNotNull())
    for i, r in enumerate(contract.rules):
        if r.rule == "not_null":
            conditions[f"not_null:{','.join(r.columns)}"] = (r.severity, any_of([F.col(c).isNull() for c in r.columns]))
        elif r.rule == "referential_integrity":
            table, column = r.references.split(".")
            try:
                parent = tables(table).select(F.col(column).alias(f"_ref{i}")).where(f"_ref{i} IS NOT NULL").distinct()
            except Exception as e:
                raise ContractError(f"reference {r.references} can't be read") from e
            marked = marked.join(parent, F.col(r.columns[0]) == F.col(f"_ref{i}"), "left")
            conditions[f"referential_integrity:{r.columns[0]}"] = (r.severity, F.col(r.columns[0]).isNotNull() & F.col(f"_ref{i}").isNull())
        elif r.rule == "freshness":
            newest = df.agg(F.max(r.columns[0]).cast("timestamp").alias("m")).first()["m"]
            stale = newest is None or (now or datetime.utcnow()) - newest.replace(tzinfo=None) > _hours(r.max_age_hours)
            if stale and r.severity == "error":
                raise ContractError(f"{contract.table} is stale: newest {r.columns[0]} is {newest}")
            conditions[f"freshness:{r.columns[0]}"] = (r.severity, F.lit(bool(stale)))
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, (s, c) in conditions.items() if s == "error"], F.lit(None).cast("string")))
    marked = marked.withColumn("_reasons", reasons)
    good = marked.where(F.size("_reasons") == 0).select(*df.columns)
    bad = marked.where(F.size("_reasons") > 0).select(*df.columns, F.concat_ws("|", "_reasons").alias("reasons"))
    return Verdict(good, bad, marked, conditions)


def _hours(n: float):
    from datetime import timedelta

    return timedelta(hours=n)


def latest_valid(history: DataFrame, contract: Contract, snapshot: str, tables=None, now=None) -> tuple[DataFrame, Verdict]:
    """The last valid state of each grain: an older valid state beats a newer invalid one."""
    verdict = validate(history, contract, tables, (snapshot,), now)
    return latest(verdict.valid, list(contract.grain), snapshot), verdict


def check_grain(contract: Contract, keys: list[str]) -> None:
    if list(contract.grain) != list(keys):
        raise ContractError(f"{contract.table}: grain is {list(contract.grain)}, the runtime uses {list(keys)}")


def inventory(spark, contracts: list[Contract]) -> DataFrame:
    """One row a contract: what it states, for review."""
    rows = [(c.table, c.owner, ",".join(c.grain), len(c.columns), sum(not x.nullable for x in c.columns), len(c.rules), sum(r.severity == "warning" for r in c.rules)) for c in contracts]
    return spark.createDataFrame(rows, "table string, owner string, grain string, n_columns int, n_required int, n_rules int, n_warnings int")
