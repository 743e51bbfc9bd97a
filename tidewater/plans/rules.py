"""Typing and data contracts as queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.typing import Typing, apply_typing, decimal_comma, parse_timestamp
from ..operators.contracts import Contract, latest_valid, validate
from .registry import query
from .relations import SQL_LINES, Relations

EVENTS = Contract.from_dict(
    {
        "table": "events",
        "grain": ["user_id"],
        "columns": [
            {"name": "event_id", "type": "bigint", "nullable": False, "unique": True},
            {"name": "user_id", "type": "bigint", "nullable": False},
            {"name": "event_type", "type": "string", "accepted_values": ["view", "click", "signup", "purchase"]},
            {"name": "amount", "type": "decimal(14,2)", "min": 1, "max": 200},
        ],
    }
)
LINES = Contract.from_dict(
    {
        "table": "lines",
        "grain": ["order_id", "line"],
        "columns": [
            {"name": "order_id", "type": "bigint", "nullable": False},
            {"name": "line", "type": "int", "nullable": False},
            {"name": "supplier_id", "type": "bigint"},
            {"name": "quantity", "type": "decimal(14,3)", "min": 2},
            {"name": "l_returnflag", "type": "string", "accepted_values": ["A", "R"]},
        ],
        "quality_rules": [{"rule": "no_duplicates"}, {"rule": "not_null", "columns": ["supplier_id"], "severity": "warning"}],
    }
)
ORDERS = Contract.from_dict(
    {
        "table": "orders",
        "grain": ["o_orderkey"],
        "columns": [{"name": "o_orderkey", "type": "bigint", "nullable": False}, {"name": "o_custkey", "type": "bigint"}, {"name": "ordered", "type": "timestamp"}],
        "quality_rules": [
            {"rule": "referential_integrity", "columns": ["o_custkey"], "references": "customers.c_custkey", "severity": "warning"},
            {"rule": "freshness", "columns": ["ordered"], "max_age_hours": 48, "severity": "warning"},
        ],
    }
)
#: The fixed time freshness is judged at.
NOW = datetime(2001, 8, 10)

SQL_EVENTS = "ev AS (SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, CAST(ts AS DATE) AS day, event_type, CAST(value AS DECIMAL(14,2)) AS amount FROM events)"


def events(r: Relations) -> DataFrame:
    return r.table("events").select("event_id", "user_id", "ts", F.to_date("ts").alias("day"), "event_type", F.col("value").cast("decimal(14,2)").alias("amount"))


@query("contract_quarantine_lineitem", "DC3 DC4 DC5 DC8 W4", f"""WITH {SQL_LINES}, m AS (SELECT *, count(*) OVER (PARTITION BY order_id, line) > 1 AS dup FROM lines)
SELECT order_id, line, part_id, supplier_id, quantity, l_returnflag, concat_ws('|', CASE WHEN quantity < 2 THEN 'min:quantity' END, CASE WHEN l_returnflag NOT IN ('A', 'R') THEN 'accepted_values:l_returnflag' END, CASE WHEN dup THEN 'no_duplicates:order_id,line' END) AS reasons
FROM m WHERE dup OR quantity < 2 OR l_returnflag NOT IN ('A', 'R')""")
def contract_quarantine(r: Relations) -> DataFrame:
    bad = validate(r.lines, LINES).quarantine
    return bad.select("order_id", "line", "part_id", "supplier_id", "quantity", "l_returnflag", "reasons")


@query("contract_rule_report", "DC2 DC3 DC4 DC5 DC8 A3 P12", f"""WITH {SQL_EVENTS}, m AS (SELECT *, count(*) OVER (PARTITION BY event_id) > 1 AS dup FROM ev),
s AS (SELECT count(*) FILTER (event_id IS NULL) AS a, count(*) FILTER (user_id IS NULL) AS b, count(*) FILTER (event_type NOT IN ('view', 'click', 'signup', 'purchase')) AS c, count(*) FILTER (amount < 1) AS d, count(*) FILTER (amount > 200) AS e, count(*) FILTER (dup) AS f FROM m)
SELECT unnest(['not_null:event_id', 'not_null:user_id', 'accepted_values:event_type', 'min:amount', 'max:amount', 'unique:event_id']) AS rule, 'error' AS severity, unnest([a, b, c, d, e, f])::BIGINT AS failures FROM s""")
def contract_rule_report(r: Relations) -> DataFrame:
    return validate(events(r), EVENTS).report()


@query("contract_ri_warning", "DC6 DC7 DC8 J13", """WITH p AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
SELECT 'not_null:o_orderkey' AS rule, 'error' AS severity, count(*) FILTER (o_orderkey IS NULL)::BIGINT AS failures FROM orders
UNION ALL SELECT 'referential_integrity:o_custkey', 'warning', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM p)
UNION ALL SELECT 'freshness:ordered', 'warning', CASE WHEN max(CAST(o_orderdate AS TIMESTAMP)) < TIMESTAMP '2001-08-08 00:00:00' THEN count(*) ELSE 0 END FROM orders""")
def contract_ri_warning(r: Relations) -> DataFrame:
    parents = {"customers": r.table("customer").where("c_acctbal > 0")}
    return validate(r.orders, ORDERS, parents.__getitem__, now=NOW).report()


@query("contract_scoped_unique", "DC5", f"""WITH {SQL_EVENTS}, a AS (SELECT count(*) OVER (PARTITION BY user_id) > 1 AS dup FROM ev), b AS (SELECT count(*) OVER (PARTITION BY user_id, day) > 1 AS dup FROM ev)
SELECT 'all' AS scope, count(*) FILTER (NOT dup) AS valid, count(*) FILTER (dup) AS quarantined FROM a UNION ALL SELECT 'day', count(*) FILTER (NOT dup), count(*) FILTER (dup) FROM b""")
def contract_scoped_unique(r: Relations) -> DataFrame:
    contract = Contract.from_dict({"table": "e", "grain": ["user_id"], "columns": [{"name": "user_id", "type": "bigint"}], "quality_rules": [{"rule": "no_duplicates"}]})

    def counted(name: str, scope: tuple[str, ...]) -> DataFrame:
        bad = F.size("_reasons") > 0
        return validate(events(r), contract, scope=scope).marked.agg(F.lit(name).alias("scope"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("quarantined"))

    return counted("all", ()).unionByName(counted("day", ("day",)))


@query("contract_freshness", "DC7 A1", """SELECT 'fresh' AS case_name, 'freshness:ordered' AS rule, CASE WHEN max(CAST(o_orderdate AS TIMESTAMP)) < TIMESTAMP '1990-01-01' THEN count(*) ELSE 0 END::BIGINT AS failures FROM orders
UNION ALL SELECT 'stale', 'freshness:ordered', count(*) FROM orders""")
def contract_freshness(r: Relations) -> DataFrame:
    report = lambda name, now: validate(r.orders, ORDERS, lambda _: r.table("customer"), now=now).report().where("rule = 'freshness:ordered'").select(F.lit(name).alias("case_name"), "rule", "failures")
    return report("fresh", datetime(1990, 1, 3)).unionByName(report("stale", datetime(2050, 1, 1)))


@query("latest_valid_state", "W1 DC9 P14", f"""WITH {SQL_EVENTS}, v AS (SELECT * FROM ev WHERE event_type <> 'error' AND amount BETWEEN 1 AND 200), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk FROM v)
SELECT user_id, event_id, event_type, amount FROM k WHERE rk = 1""")
def latest_valid_state(r: Relations) -> DataFrame:
    state, _ = latest_valid(events(r), EVENTS, "ts")
    return state.select("user_id", "event_id", "event_type", "amount")


def _raw_lines(r: Relations) -> DataFrame:
    """Lines as the raw layer has them: text, with decimal commas."""
    comma = lambda c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))
    return r.lines.select(F.col("order_id").cast("string"), F.col("line").cast("string"), F.col("part_id").cast("string"), comma("amount").alias("amount"), comma("quantity").alias("quantity"), F.date_format("shipped", "yyyy/MM/dd HH:mm:ss.SSS").alias("shipped"))


@query("typing_decimal_comma", "P1 P2 P3", f"""WITH {SQL_LINES}
SELECT order_id::VARCHAR AS order_id, line::VARCHAR AS line, part_id::VARCHAR AS part_id, amount AS total_value, quantity, shipped::VARCHAR AS shipped, year(shipped)::INT AS year, month(shipped)::INT AS month FROM lines""")
def typing_decimal_comma(r: Relations) -> DataFrame:
    cfg = Typing(decimals={"amount": (14, 2), "quantity": (14, 3)}, business_date="shipped", renames={"amount": "total_value"})
    return apply_typing(_raw_lines(r), cfg).withColumn("shipped", F.col("shipped").cast("string"))


@query("try_parse_bad_values", "P1 SCD2", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(value AS DECIMAL(14,3)) END AS amount, CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END AS at FROM events""")
def try_parse_bad_values(r: Relations) -> DataFrame:
    amount = F.when(F.col("event_id") % 4 == 0, "N").otherwise(F.replace(F.col("value").cast("decimal(14,3)").cast("string"), F.lit("."), F.lit(",")))
    at = F.when(F.col("event_id") % 3 == 0, "2024-13-45").when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSS")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    raw = r.table("events").select("event_id", amount.alias("amount"), at.alias("at"))
    return raw.select("event_id", decimal_comma("amount", lenient=True).alias("amount"), F.date_format(parse_timestamp("at", "yyyy/MM/dd HH:mm:ss.SSS"), "yyyy-MM-dd HH:mm:ss").alias("at"))
