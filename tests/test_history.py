"""Histories: the scenarios of snapshots with gaps, trusted boundaries and late evidence."""

from __future__ import annotations

import datetime as dt

import pytest

from tidewater.operators.history import HistoryPolicy, apply_snapshot, backfill, classify_snapshot, invariants, replay_days
from tidewater.operators.state import multiset_difference

POLICY = HistoryPolicy("id", ("tax", "name"), ("phone",), initial="created", compare="date", watch=("tax",))
SCHEMA = "id long, tax string, name string, phone string, created timestamp, snapshot date"
D = [dt.date(2026, 9, n) for n in range(1, 8)]
BORN = dt.datetime(2026, 1, 1, 8)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def snapshots(spark):
    rows = [
        (1, "t1", "a", "p1", BORN, D[0]), (1, "t1", "a", "p2", BORN, D[1]), (1, "t1", "b", "p2", BORN, D[2]), (1, "t2", "b", None, BORN, D[3]),
        (2, "t9", "x", "q", dt.datetime(2026, 9, 4, 10, 30), D[3]), (3, "t7", "y", "r", dt.datetime(2026, 9, 6), D[3]),
    ]
    return frame(spark, rows)


def versions(history):
    return sorted((r["id"], r["tax"], r["name"], r["phone"], r["valid_from"], r["valid_to"], r["valid_from_source"]) for r in history.collect())


def test_backfill(snapshots):
    at = lambda d: dt.datetime(d.year, d.month, d.day)
    assert versions(backfill(snapshots, POLICY)) == [
        (1, "t1", "a", None, BORN, at(D[2]), "created"), (1, "t1", "b", None, at(D[2]), at(D[3]), "snapshot"), (1, "t2", "b", None, at(D[3]), None, "snapshot"),
        (2, "t9", "x", "q", dt.datetime(2026, 9, 4, 10, 30), None, "created"),  # the same day counts as not after the snapshot
        (3, "t7", "y", "r", at(D[3]), None, "snapshot"),  # a creation after the snapshot isn't trusted
    ]


@pytest.mark.parametrize("from_day", [1, 3])
def test_steps_equal_the_backfill_and_replays_change_nothing(spark, snapshots, from_day):
    start = backfill(snapshots.where(f"snapshot <= '{D[from_day - 1]}'"), POLICY)
    stepped = replay_days(start, snapshots, POLICY, D[from_day:4])
    full = backfill(snapshots, POLICY)
    assert tuple(multiset_difference(stepped, full).first()) == (0, 0)
    assert tuple(multiset_difference(apply_snapshot(full, snapshots, POLICY, D[3]), full).first()) == (0, 0)


def test_reappearance_compares_with_the_last_observation(spark):
    rows = [(1, "t", "a", "p", BORN, D[0]), (1, "t", "a", "p9", BORN, D[2]), (1, "t", "z", "p9", BORN, D[4]), *[(9, "k", "k", "k", BORN, d) for d in D[:5]]]
    df = frame(spark, rows)
    full = backfill(df, POLICY)
    one = [r for r in versions(full) if r[0] == 1]
    assert [(r[4], r[5]) for r in one] == [(BORN, dt.datetime(2026, 9, 5)), (dt.datetime(2026, 9, 5), None)]
    stepped = replay_days(backfill(df.where(f"snapshot <= '{D[0]}'"), POLICY), df, POLICY, D[1:5])
    assert tuple(multiset_difference(stepped, full).first()) == (0, 0)
    kinds = {(r["id"], r["class"], r["reappeared"]) for r in classify_snapshot(df, POLICY, D[2]).collect()}
    assert kinds == {(1, "type1", True), (9, "unchanged", False)}
    assert {(r["id"], r["class"]) for r in classify_snapshot(df, POLICY, D[1]).collect()} == {(1, "gone"), (9, "unchanged")}


def test_repeated_keys_in_a_snapshot_raise(spark, snapshots):
    twice = snapshots.unionByName(frame(spark, [(1, "t2", "c", "p", BORN, D[3])]))
    with pytest.raises(ValueError, match="repeated"):
        apply_snapshot(backfill(snapshots, POLICY), twice, POLICY, D[3])


def test_invariants_find_faults(spark, snapshots):
    full = backfill(snapshots, POLICY)
    assert all(r["passed"] for r in invariants(full, POLICY).collect())
    broken = full.unionByName(full.where("id = 1 AND is_current"))
    failed = {r["check"] for r in invariants(broken, POLICY).collect() if not r["passed"]}
    assert {"one_current", "unique_version", "no_redundant_version"} <= failed
