"""Contracts and schema drift: what passes, what is set aside and what stops everything."""

from __future__ import annotations

import datetime as dt

import pytest

from tidewater.operators.contracts import Contract, ContractError, check_grain, latest_valid, validate
from tidewater.operators.drift import DriftError, DriftRegistry, classify

SPEC = {
    "table": "sales",
    "grain": ["id"],
    "columns": [{"name": "id", "type": "string", "nullable": False}, {"name": "at", "type": "timestamp"}, {"name": "store", "type": "string"}, {"name": "amount", "type": "decimal(14,2)", "min": 0}],
    "quality_rules": [
        {"rule": "no_duplicates"}, {"rule": "referential_integrity", "columns": ["store"], "references": "stores.id", "severity": "warning"}, {"rule": "freshness", "columns": ["at"], "max_age_hours": 24, "severity": "warning"},
    ],
}
NOW = dt.datetime(2026, 9, 3)


@pytest.fixture
def sales(spark):
    rows = [("a", "1", 5), ("a", "1", 6), ("b", "9", -1), (None, "1", 1), ("c", "1", 2), ("d", None, 3)]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({'NULL' if i is None else repr(i)}, TIMESTAMP '2026-09-01', {'NULL' if s is None else repr(s)}, CAST({n} AS DECIMAL(14,2)))" for i, s, n in rows) + " t(id, at, store, amount)").selectExpr("CAST(id AS STRING) AS id", "at", "CAST(store AS STRING) AS store", "amount")


def test_quarantine_and_warnings(spark, sales):
    stores = spark.createDataFrame([("1",), ("1",)], "id string")
    verdict = validate(sales, Contract.from_dict(SPEC), {"stores": stores}.__getitem__, now=NOW)
    assert sorted(r["id"] for r in verdict.valid.collect()) == ["c", "d"]
    assert sorted((str(r["id"]), r["reasons"]) for r in verdict.quarantine.collect()) == [("None", "not_null:id"), ("a", "no_duplicates:id"), ("a", "no_duplicates:id"), ("b", "min:amount")]
    report = {r["rule"]: (r["severity"], r["failures"]) for r in verdict.report().collect()}
    assert report["referential_integrity:store"] == ("warning", 1) and report["freshness:at"] == ("warning", 6)


@pytest.mark.parametrize("change", ["missing", "type", "reference", "stale"])
def test_structure_references_and_age_stop_everything(spark, sales, change):
    spec = dict(SPEC)
    df = sales.drop("store") if change == "missing" else sales.selectExpr("id", "at", "store", "CAST(amount AS STRING) AS amount") if change == "type" else sales
    if change == "stale":
        spec["quality_rules"] = [{"rule": "freshness", "columns": ["at"], "max_age_hours": 24}]
    with pytest.raises(ContractError):
        validate(df, Contract.from_dict(spec), {}.__getitem__, now=NOW)


def test_wrong_definitions_are_told_together():
    with pytest.raises(ContractError) as e:
        Contract.from_dict({"table": "x", "grain": ["k"], "columns": [{"name": "a"}], "quality_rules": [{"rule": "odd"}, {"rule": "freshness"}]})
    assert all(x in str(e.value) for x in ("no type", "grain column", "'odd'", "freshness"))
    with pytest.raises(ContractError):
        check_grain(Contract.from_dict(SPEC), ["other"])


def test_an_older_valid_state_beats_a_newer_bad_one(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', DATE '2026-09-01', 1), ('a', DATE '2026-09-02', -1), ('b', DATE '2026-09-01', 2), ('b', DATE '2026-09-01', 2), ('b', DATE '2026-09-02', 3) t(id, day, n)")
    contract = Contract.from_dict({"table": "t", "grain": ["id"], "columns": [{"name": "id", "type": "string"}, {"name": "n", "type": "int", "min": 0}], "quality_rules": [{"rule": "no_duplicates"}]})
    state, verdict = latest_valid(df, contract, "day")
    assert sorted((r["id"], r["n"]) for r in state.collect()) == [("a", 1), ("b", 3)] and verdict.quarantine.count() == 3


def test_drift(spark, tmp_path):
    frame = lambda ddl: spark.createDataFrame([], ddl)
    base = frame("id string, amount int")
    for registry in (DriftRegistry(tmp_path / "local"), DriftRegistry(f"file://{tmp_path}/shared", spark)):
        with pytest.raises(DriftError, match="no accepted baseline"):
            registry.evaluate("sales", base)
        registry.bootstrap("sales", base, "me", "first")
        with pytest.raises(DriftError):
            registry.bootstrap("sales", base, "me", "again")
        assert registry.evaluate("sales", frame("amount int, id string")).columns == ["id", "amount"]
        more = frame("id string, amount int, new_col string")
        assert registry.evaluate("sales", more).columns == ["id", "amount"]
        for bad in ("id string", "id string, amount string"):
            with pytest.raises(DriftError):
                registry.evaluate("sales", frame(bad))
        with pytest.raises(DriftError) as e:
            registry.evaluate("sales", more, additive_allowed=False)
        event = str(e.value).rpartition("(")[2].rstrip(")")
        assert registry.promote(event, "me", "wanted")["version"] == 2
        assert registry.evaluate("sales", more).columns == ["id", "amount", "new_col"]
        with pytest.raises(DriftError, match="another baseline"):
            registry.promote(event, "me", "again")
        assert [(r["entity"], r["state"]) for r in registry.audit({"sales": more, "other": base}).collect()] == [("other", "missing_baseline"), ("sales", "no_drift")]


def test_drift_classes():
    base = {"id": "string", "n": "int"}
    kinds = [classify(base, x)[0] for x in (base, base | {"m": "int"}, {"id": "string"}, {"id": "string", "n": "string"}, {"id": "string", "m": "int"})]
    assert kinds == ["no_drift", "additive", "removed_column", "type_change", "mixed_breaking"]


def test_volume_and_rate_of_nulls(spark):
    from tidewater.operators import quality

    df = spark.createDataFrame([(i, None if i < 3 else i) for i in range(100)], "id int, v int")
    assert [tuple(r) for r in quality.volume(df, df.unionByName(df.limit(1))).collect()] == [("volume", 0, True)]
    assert [tuple(r) for r in quality.volume(df.limit(50), df).collect()] == [("volume", 50, False)]
    assert [tuple(r) for r in quality.null_rate(df, "v", 0.03).collect()] == [("null_rate:v", 0, True)]
    assert [tuple(r) for r in quality.null_rate(df, "v", 0.02).collect()] == [("null_rate:v", 3, False)]


def test_a_column_that_a_rule_names_is_unique_once(spark):
    from tidewater.operators.contracts import Contract, validate

    spec = {"table": "t", "grain": ["id"], "columns": [{"name": "id", "type": "int", "unique": True}], "quality_rules": [{"rule": "no_duplicates", "columns": ["id"]}]}
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id int")
    verdict = validate(df, Contract.from_dict(spec))
    assert [tuple(r) for r in verdict.report().collect()] == [("no_duplicates:id", "error", 4)]
    assert [r["id"] for r in verdict.valid.collect()] == [2] and verdict.quarantine.count() == 4
