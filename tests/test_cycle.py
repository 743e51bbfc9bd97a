"""The fact cycle over daily files: closed days only, absence deletes nothing, mutation blocks, crashes are made good."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tidewater.operators.incremental import StateError, maturity_cutoff, merge_backfill, repair_open_days, restore_contaminated
from tidewater.operators.manifest import MutationError
from tidewater.plans.cycle import assemble, seed
from tidewater.sources.raw import append_daily_parquet

D = [dt.date(2026, 9, n) for n in range(1, 5)]
SCHEMA = "user_id long, day date, kind string, events long"


@pytest.fixture
def files(spark, tmp_path):
    def write(rows):
        append_daily_parquet(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/files", "day")

    write([(1, D[0], "view", 1), (2, D[0], "view", 1)])
    write([(2, D[1], "click", 2), (3, D[1], "view", 1), (4, D[1], "odd", 1)])
    write([(2, D[2], "click", 3), (5, D[2], "view", 0)])
    return write


def state(pipeline):
    return {r["user_id"]: (r["day"], r["kind"], r["events"]) for r in pipeline.target.read().collect()}


def test_cycle(spark, tmp_path, files):
    make = lambda cutoff: assemble(spark, str(tmp_path), f"{tmp_path}/files", cutoff)
    with pytest.raises(StateError, match="no watermark"):
        make(D[0]).apply()
    seed(make(D[0]), D[0])
    assert make(D[0]).apply() == "nothing closed"
    p = make(D[1])
    assert p.apply() == "applied" and p.apply() == "pending"
    assert state(p) == {1: (D[0], "view", 1), 2: (D[1], "click", 2), 3: (D[1], "view", 1)}  # nothing of the open third day
    assert [(r["user_id"], r["reasons"]) for r in p.quarantine.read().collect()] == [(4, "accepted_values:kind")]
    assert p.commit.__self__.watermarks.get("user_days")["status"] == "PENDING_VALIDATION"
    p.validate()
    p.validate()  # a retry finds the same files
    p.manifest.promote(D[0], D[1])  # a crash after the manifest, before the watermark
    assert p.commit() and not p.commit()
    assert p.watermarks.get("user_days")["committed"] == D[1]
    p = make(D[2])
    p.apply()
    p.validate()
    p.commit()
    assert state(p)[1] == (D[0], "view", 1) and state(p)[2] == (D[2], "click", 3)
    assert p.quarantine_history.read().count() == 2
    before = state(p)
    time.sleep(0.01)
    files([(9, D[1], "view", 1)])  # a committed day gets another file
    with pytest.raises(MutationError):
        make(D[3]).apply()
    assert state(p) == before


def test_mutation_between_validate_and_commit(spark, tmp_path, files):
    seed(assemble(spark, str(tmp_path), f"{tmp_path}/files", D[0]), D[0])
    p = assemble(spark, str(tmp_path), f"{tmp_path}/files", D[1])
    p.apply()
    p.validate()
    files([(7, D[1], "view", 1)])
    with pytest.raises(MutationError):
        assemble(spark, str(tmp_path), f"{tmp_path}/files", D[1]).commit()
    assert p.watermarks.get("user_days")["committed"] == D[0]


def test_maturity_reads_the_files_times(spark, tmp_path, files):
    for day in (D[0], D[1], D[2]):
        folder = f"{tmp_path}/files/day={day}"
        at = dt.datetime(2026, 9, 3, 1, tzinfo=dt.timezone.utc).timestamp()
        for name in os.listdir(folder):
            os.utime(f"{folder}/{name}", (at, at))
    assert assemble(spark, str(tmp_path), f"{tmp_path}/files").cutoff() == D[1]


def test_maturity_wants_every_file_later(spark):
    rows = [(D[0], dt.datetime(2026, 9, 2)), (D[1], dt.datetime(2026, 9, 3)), (D[1], dt.datetime(2026, 9, 2, 23)), (D[2], dt.datetime(2026, 9, 3, 23, 59))]
    assert maturity_cutoff(spark.createDataFrame(rows, "day date, modified_at timestamp")).first()["cutoff"] == D[0]
    assert maturity_cutoff(spark.createDataFrame([], "day date, modified_at timestamp")).first()["cutoff"] is None


def test_repairs(spark):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    history = frame([(1, D[0], "a", 1), (1, D[2], "b", 2), (2, D[1], "c", 3), (3, D[3], "d", 4)])
    now = frame([(1, D[2], "b", 2), (2, D[1], "c", 3), (3, D[3], "d", 4)])
    got = {(r["user_id"], r["kind"]) for r in restore_contaminated(now, history, ["user_id"], "day", D[1]).collect()}
    assert got == {(1, "a"), (2, "c")}
    got = {(r["user_id"], r["kind"]) for r in repair_open_days(now, frame([(1, D[0], "a", 1)]), ["user_id"], "day", D[1]).collect()}
    assert got == {(1, "a"), (2, "c")}
    both = merge_backfill(frame([(1, D[0], "daily", 1)]), frame([(1, D[0], "old", 1), (1, D[1], "old", 2)]), ["user_id"], "day")
    assert sorted((r["day"], r["kind"], r["origin"]) for r in both.collect()) == [(D[0], "daily", "daily"), (D[1], "old", "backfill")]


def test_watermarks_move_by_compare_and_set(spark, tmp_path):
    w = assemble(spark, str(tmp_path), f"{tmp_path}/none").watermarks
    assert w.seed("e", D[0]) and not w.seed("e", D[2])
    with pytest.raises(StateError):
        w.move("e", "PENDING_VALIDATION", "COMMITTED", D[1], None)
    with pytest.raises(StateError):
        w.move("e", "COMMITTED", "COMMITTED", D[1], None)
    w.move("e", "COMMITTED", "PENDING_VALIDATION", D[0], D[1])
    assert w.get("e")["candidate"] == D[1]
    assert w.table.read().where(F.col("status") == "COMMITTED").count() == 0
