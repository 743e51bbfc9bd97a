"""Attribute profiles and contamination by open days, on cases that the driver's tables don't have."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from tidewater.operators import profile

D = [date(2026, 9, n) for n in range(1, 5)]
SCHEMA = "id int, day date, a string, b int"


def test_attributes_with_nulls_and_absences(spark):
    rows = [(1, D[0], None, 1), (1, D[1], "x", 1), (1, D[2], None, 2), (2, D[0], "x", 5), (2, D[2], "x", 5), (3, D[1], "y", None)]
    got = {r["attribute"]: tuple(r)[1:] for r in profile.attribute_profile(spark.createDataFrame(rows, SCHEMA), "id", "day", ["a", "b"]).collect()}
    assert got == {"a": (1, 1, 2, 1), "b": (0, 2, 1, 1)}  # a first null isn't a change, a null after a value is


def test_contamination_tells_new_changed_and_repeated_keys(spark):
    rows = [(1, D[0], "x", 1), (1, D[2], "x", 1), (2, D[0], "x", 1), (2, D[3], None, 1), (3, D[3], "z", 1), (4, D[1], "x", 1), (5, D[1], None, 1), (5, D[3], None, 1)]
    payload = F.col("a")
    got = profile.contamination(spark.createDataFrame(rows, SCHEMA), "id", "day", D[1], payload).collect()
    assert {r["day"]: tuple(r)[1:] for r in got} == {D[2]: (1, 0, 0, 1), D[3]: (3, 1, 1, 1)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert profile.attribute_profile(empty, "id", "day", ["a", "b"]).count() == 0
    assert profile.contamination(empty, "id", "day", D[0], F.col("a")).count() == 0
