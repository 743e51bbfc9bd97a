"""Schema drift against an explicitly accepted baseline; baselines, events and promotions are JSON files."""

from __future__ import annotations

import hashlib
import json
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.control import ControlFiles, LocalFiles


class DriftError(RuntimeError):
    pass


def schema_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema}


def schema_hash(schema: dict[str, str]) -> str:
    """Doesn't depend on column order; nullability isn't part of it."""
    return hashlib.sha256(json.dumps(schema, sort_keys=True).encode()).hexdigest()


def classify(baseline: dict[str, str], observed: dict[str, str]) -> tuple[str, dict]:
    """no_drift, additive, removed_column, type_change or mixed_breaking, with the difference."""
    diff = {"added": sorted(set(observed) - set(baseline)), "removed": sorted(set(baseline) - set(observed)), "changed": {c: [baseline[c], observed[c]] for c in sorted(set(baseline) & set(observed)) if baseline[c] != observed[c]}}
    kinds = [k for k, name in (("additive", "added"), ("removed_column", "removed"), ("type_change", "changed")) if diff[name]]
    return (kinds[0] if len(kinds) == 1 else "mixed_breaking" if kinds else "no_drift"), diff


class DriftRegistry:
    """``spark``: keeps the files where Spark's file systems reach; without it, in a local folder."""

    def __init__(self, root: str | Path, spark: SparkSession | None = None):
        self.files = ControlFiles(str(root), spark) if spark else LocalFiles(root)

    def baseline(self, entity: str) -> dict | None:
        """The accepted baseline; a bare {column: type} file of old is read as version 1."""
        found = self.files.read(f"baselines/{entity}")
        if found is not None and "schema" not in found:
            found = {"entity": entity, "version": 1, "schema": found, "columns": list(found), "schema_hash": schema_hash(found)}
        return found

    def bootstrap(self, entity: str, df: DataFrame, by: str, reason: str, source: str = "") -> dict:
        """Accepts the present schema; never overwrites a baseline."""
        if self.baseline(entity):
            raise DriftError(f"{entity} has a baseline")
        return self._accept(entity, 1, schema_of(df), df.columns, by, reason, source)

    def _accept(self, entity: str, version: int, schema: dict, columns: list[str], by: str, reason: str, source: str) -> dict:
        value = {"entity": entity, "version": version, "schema": schema, "columns": list(columns), "schema_hash": schema_hash(schema), "accepted_at": datetime.now(timezone.utc).isoformat(), "accepted_by": by, "reason": reason, "source": source}
        self.files.write(f"baselines/{entity}", value)
        return value

    def evaluate(self, entity: str, df: DataFrame, additive_allowed: bool = True) -> DataFrame:
        """``df`` in the baseline's columns and order, or an error. Drift leaves an event, once for each pair of schemas."""
        base = self.baseline(entity)
        if base is None:
            raise DriftError(f"{entity} has no accepted baseline")
        observed = schema_of(df)
        kind, diff = classify(base["schema"], observed)
        if kind != "no_drift":
            event = self._event(entity, base, observed, df.columns, kind, diff)
            if kind != "additive" or not additive_allowed:
                raise DriftError(f"{entity}: {kind} ({event})")
        return df.select(*base["columns"])

    def _event(self, entity: str, base: dict, observed: dict, columns: list[str], kind: str, diff: dict) -> str:
        new = schema_hash(observed)
        event = hashlib.sha256(f"{entity}|{base['schema_hash']}|{new}".encode()).hexdigest()[:24]
        if self.files.read(f"events/{event}") is None:
            self.files.write(f"events/{event}", {"event": event, "entity": entity, "kind": kind, "diff": diff, "baseline_hash": base["schema_hash"], "observed_hash": new, "observed": observed, "columns": columns, "detected_at": datetime.now(timezone.utc).isoformat()})
        return event

    def promote(self, event: str, by: str, reason: str, breaking: bool = False) -> dict:
        """Makes an event's schema the baseline; a breaking one only if asked for, and only on the baseline it was seen against."""
        found = self.files.read(f"events/{event}")
        if found is None:
            raise DriftError(f"event {event} is unknown")
        base = self.baseline(found["entity"])
        if found["kind"] != "additive" and not breaking:
            raise DriftError(f"event {event} is {found['kind']}")
        if base["schema_hash"] != found["baseline_hash"]:
            raise DriftError(f"event {event} was seen against another baseline")
        columns = [*[c for c in base["columns"] if c in found["observed"]], *[c for c in found["columns"] if c not in base["columns"]]]
        value = self._accept(found["entity"], base["version"] + 1, found["observed"], columns, by, reason, event)
        self.files.write(f"promotions/{event}", {"event": event, "by": by, "reason": reason, "version": value["version"]})
        return value

    def audit(self, tables: dict[str, DataFrame]) -> DataFrame:
        """entity, state, version: every table against its baseline; schemas only, no data are read."""
        rows = []
        for entity, df in sorted(tables.items()):
            base = self.baseline(entity)
            rows.append((entity, "missing_baseline" if base is None else classify(base["schema"], schema_of(df))[0], base and base["version"]))
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame(rows, "entity string, state string, version int")


def probe(df: DataFrame, extra: dict[str, str]) -> DataFrame:
    """No rows of ``df``'s schema with typed technical columns, to put before ``evaluate``."""
    return df.limit(0).select("*", *[F.lit(None).cast(t).alias(n) for n, t in extra.items()])
