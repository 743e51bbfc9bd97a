"""Versioned tables, sources and control files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewater.operators.state import multiset_difference
from tidewater.sources.control import verified_copy, verified_move
from tidewater.sources.raw import file_metadata, read_raw_csv, write_raw_csv
from tidewater.sources.store import VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t")
    t.overwrite(spark.createDataFrame([(1, "a", 1), (2, None, 1)], "id int, v string, at int"))
    return t


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_changes_are_versions(spark, table):
    frame = lambda r: spark.createDataFrame(r, "id int, v string, at int")
    table.append(frame([(3, "c", 1)]))
    table.upsert(frame([(1, "new", 2), (4, "d", 2)]), ["id"])
    assert rows(table.read()) == [(1, "new", 2), (2, None, 1), (3, "c", 1), (4, "d", 2)]
    table.delete(F.col("v") == "c")  # rows with a null condition stay
    assert [r[0] for r in rows(table.read())] == [1, 2, 4]
    table.upsert_newest(frame([(1, "older", 1), (2, "newer", 5)]), ["id"], "at")
    assert rows(table.read()) == [(1, "new", 2), (2, "newer", 5), (4, "d", 2)]
    assert rows(table.read(0)) == [(1, "a", 1), (2, None, 1)]
    table.restore(0)
    assert tuple(multiset_difference(table.read(), table.read(0)).first()) == (0, 0)
    assert [r["operation"] for r in table.history().orderBy("version").collect()] == ["overwrite", "append", "upsert", "delete", "upsert newest", "restore 0"]
    assert table.vacuum() == 0 and table.vacuum(retain_hours=0) > 0
    assert rows(table.read()) == [(1, "a", 1), (2, None, 1)] and len(table.versions()) == 1


def test_writers_that_come_second_fail(spark, table, monkeypatch):
    stale = table.versions()
    table.append(table.read())
    monkeypatch.setattr(table, "versions", lambda: stale)
    with pytest.raises(RuntimeError, match="written by another"):
        table.append(table.read(0))


def test_a_commit_between_read_and_write_is_not_undone(spark, table, monkeypatch):
    other, write = VersionedTable(spark, table.path), table._write
    more = spark.createDataFrame([(9, "z", 1)], "id int, v string, at int")

    def meanwhile(df):
        part = write(df)
        other.append(more)
        return part

    monkeypatch.setattr(table, "_write", meanwhile)
    for change in (lambda: table.update(F.col("id") == 1, {"v": F.lit("x")}), lambda: table.delete(F.col("id") == 1), lambda: table.upsert(more, ["id"]), lambda: table.compact(["id"])):
        with pytest.raises(RuntimeError):
            change()
    assert other.read().where("id = 9").count() == 4 and other.read().where("id = 1 AND v = 'a'").count() == 1


def test_unwritten_commit_files_are_passed_over_and_parts_are_one_scan(spark, table):
    for i in range(3):
        table.append(spark.createDataFrame([(10 + i, "m", 1)], "id int, v string, at int"))
    assert rows(table.read().select("id")) == [(1,), (10,), (11,), (12,), (2,)]
    assert table.read()._jdf.queryExecution().executedPlan().toString().count("Scan parquet") + table.read()._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") <= 2
    empty = table._Path(f"{table.path}/_log/{len(table.versions()):012d}.json")
    table._fs.create(empty, False).close()
    assert table.read().count() == 5
    with pytest.raises(RuntimeError, match="written by another"):
        table.append(table.read())


def test_vacuum_leaves_what_another_is_about_to_commit(spark, table):
    part = table._write(table.read())
    assert table.vacuum() == 0
    assert spark.read.parquet(part).count() == 2


def test_appended_columns_must_agree(spark, table):
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame([(1, 2)], "id int, other int"))


def test_partitions_are_pruned_and_counts_need_no_columns(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/p", ("year", "month"))
    t.overwrite(spark.range(100).selectExpr("id", "CAST(2020 + id % 2 AS INT) AS year", "CAST(1 + id % 12 AS INT) AS month"))
    month = t.read().where("year = 2021 AND month = 2")
    assert month.count() == len([i for i in range(100) if i % 2 == 1 and i % 12 == 1])
    files = month.select("id", "_metadata.file_path").select("file_path").distinct().collect() if "_metadata" in month.columns else []
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters")[1][:200] and not files
    count = t.read().agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in count


def test_raw_csv_keeps_text_and_dates_folders(spark, tmp_path):
    tricky = spark.createDataFrame([("1", 'a "b", c', "2026-01-31"), ("02", "1,50", "2026-02-01")], "id string, v string, ingestion_date string")
    write_raw_csv(tricky, f"{tmp_path}/csv", "ingestion_date")
    back = read_raw_csv(spark, f"{tmp_path}/csv", ["id", "v"])
    assert dict(back.dtypes) == {"id": "string", "v": "string", "ingestion_date": "date"}
    assert sorted((r["id"], r["v"]) for r in back.collect()) == [("02", "1,50"), ("1", 'a "b", c')]
    assert file_metadata(back, "ingestion_date").count() == 2


def test_copies_are_verified(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x").write_text("123")
    assert verified_copy(spark, tmp_path / "a", tmp_path / "c") == 1
    assert verified_move(spark, tmp_path / "a", tmp_path / "d") == 1 and not (tmp_path / "a").exists() and (tmp_path / "d" / "b" / "x").read_text() == "123"
