"""Partition manifest: fingerprints of the files of each committed day, which later mutation can't pass unseen."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import set_fingerprint
from ..sources.raw import file_metadata
from ..sources.store import VersionedTable

SCHEMA = "entity string, day date, fingerprint string, file_count long, max_modified_at timestamp, status string"


class MutationError(RuntimeError):
    pass


def observe(scan: DataFrame, day_column: str) -> DataFrame:
    """day, fingerprint (sorted distinct path and modification time in microseconds), file_count, max_modified_at."""
    files = file_metadata(scan, F.to_date(day_column).alias("day"))
    return files.groupBy("day").agg(set_fingerprint("file_path", F.unix_micros("modified_at")).alias("fingerprint"), F.count(F.lit(1)).alias("file_count"), F.max("modified_at").alias("max_modified_at"))


def compare(known: DataFrame, observed: DataFrame) -> DataFrame:
    """day, state of every day of either: same, missing (known, not there), extra or changed."""
    a, b = known.select("day", F.col("fingerprint").alias("_a")), observed.select("day", F.col("fingerprint").alias("_b"))
    state = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(F.col("_a") != F.col("_b"), "changed").otherwise("same")
    return a.join(b, "day", "full_outer").select("day", state.alias("state"))


def _must_match(known: DataFrame, observed: DataFrame, what: str) -> None:
    wrong = compare(known, observed).where("state <> 'same'").orderBy("day").take(10)
    if wrong:
        raise MutationError(f"{what}: {[(str(r['day']), r['state']) for r in wrong]}")


class Manifest:
    """One entity's manifest table. ``scan`` is called for each observation, so that changed files are seen."""

    def __init__(self, table: VersionedTable, entity: str, scan, day_column: str):
        self.table, self.entity, self.scan, self.day_column = table, entity, scan, day_column

    def _observed(self, after: date | None, until: date) -> DataFrame:
        seen = observe(self.scan(), self.day_column).where(F.col("day") <= F.lit(until))
        return seen if after is None else seen.where(F.col("day") > F.lit(after))

    def _rows(self, observed: DataFrame, status: str) -> DataFrame:
        return observed.select(F.lit(self.entity).alias("entity"), "day", "fingerprint", "file_count", "max_modified_at", F.lit(status).alias("status"))

    def _known(self, status: str) -> DataFrame:
        return self.table.read().where(F.col("status") == status)

    def states(self, watermark: date) -> DataFrame:
        """day, state of every day up to ``watermark``: what is committed against what is there now."""
        return compare(self._known("COMMITTED"), self._observed(None, watermark))

    def bootstrap(self, watermark: date) -> None:
        """Takes what is there up to ``watermark`` as committed; if there is a manifest, verifies it instead."""
        if self.table.exists():
            self.assert_committed(watermark)
            return
        self.table.overwrite(self._rows(self._observed(None, watermark), "COMMITTED"), "bootstrap")

    def assert_committed(self, watermark: date | None, ahead_allowed: bool = False) -> None:
        """Every committed day up to ``watermark`` is as it was, and none is committed beyond it."""
        if watermark is None:
            return
        if not self.table.exists():
            raise MutationError(f"{self.entity} has no manifest")
        known = self._known("COMMITTED")
        if not ahead_allowed and not known.where(F.col("day") > F.lit(watermark)).isEmpty():
            raise MutationError(f"{self.entity} has days committed beyond {watermark}")
        known = known.where(F.col("day") <= F.lit(watermark))
        if known.isEmpty():
            raise MutationError(f"{self.entity} has no committed day up to {watermark}")
        _must_match(known, self._observed(None, watermark), f"{self.entity}: committed days")

    def stage(self, watermark: date | None, candidate: date) -> None:
        """Notes the files that were validated, as pending; a retry must find the same."""
        if watermark is not None and candidate <= watermark:
            raise ValueError("the candidate isn't after the watermark")
        self.assert_committed(watermark)
        observed = self._observed(watermark, candidate)
        if observed.where(F.col("day") == F.lit(candidate)).isEmpty():
            raise MutationError(f"{self.entity}: no files of {candidate}")
        if self.table.exists() and not self._known("PENDING").isEmpty():
            _must_match(self._known("PENDING"), observed, f"{self.entity}: days staged before")
            return
        self.table.append(self._rows(observed, "PENDING"))

    def promote(self, watermark: date | None, candidate: date) -> None:
        """Pending days become committed if their files haven't changed since; safe to repeat after a crash."""
        self.assert_committed(watermark, ahead_allowed=True)
        observed, pending = self._observed(watermark, candidate), self._known("PENDING")
        if pending.isEmpty():
            done = self._known("COMMITTED").where(F.col("day") <= F.lit(candidate))
            _must_match(done if watermark is None else done.where(F.col("day") > F.lit(watermark)), observed, f"{self.entity}: days promoted before")
            return
        _must_match(pending, observed, f"{self.entity}: days since validation")
        self.table.update(F.col("status") == "PENDING", {"status": F.lit("COMMITTED")})
