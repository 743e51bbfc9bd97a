"""Quality gates, reconciliation, monitoring and business warnings as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hashed
from ..operators import quality
from ..operators.temporal import mapping_checks
from .registry import query
from .relations import SQL_LINES, SQL_PARTS, SQL_SALES, SQL_USERS, Relations, pit
from .star import FACT_ID, SQL_PROFILE, _with_part, calendar, sales_profile


def checks(*parts: tuple[str, str]) -> str:
    """SQL of a gate: one row (check, failures, passed) for each name and scalar."""
    return " UNION ALL ".join(f"""SELECT '{n}' AS "check", ({s})::BIGINT AS failures, ({s}) = 0 AS passed""" for n, s in parts)


def kept(r: Relations) -> DataFrame:
    """The sales fact as stored: a part of its lines is missing, to give the gates something to find."""
    return _with_part(r, r.sales, "ordered").select(hashed(*FACT_ID).alias("sale_key"), "product_key", *FACT_ID, "ordered", "amount", "quantity").where("order_id % 997 <> 3")


SQL_KEPT = f"""{SQL_SALES}, {SQL_PARTS}, kept AS (SELECT md5(concat_ws('||', order_id::VARCHAR, line::VARCHAR, sales.part_id::VARCHAR, supplier_id::VARCHAR)) AS sale_key, version_key AS product_key, order_id, line, sales.part_id, supplier_id, ordered, amount, quantity
  FROM {pit('sales', 'sales.part_id', 'ordered')} WHERE order_id % 997 <> 3)"""


@query("gate_fact", "QG8 A2 A3", f"WITH {SQL_KEPT} " + checks(
    ("unique:sale_key", "SELECT count(*) FROM (SELECT sale_key FROM kept GROUP BY 1 HAVING count(*) > 1)"),
    ("not_null:sale_key", "SELECT count(*) FROM kept WHERE sale_key IS NULL"), ("null_product_key", "SELECT count(*) FROM kept WHERE product_key IS NULL"),
    ("negative_amount", "SELECT count(*) FROM kept WHERE amount < 0"), ("volume", "SELECT CASE WHEN (SELECT count(*) FROM kept) * 100 < (SELECT count(*) FROM sales) * 99 THEN (SELECT count(*) FROM sales) - (SELECT count(*) FROM kept) ELSE 0 END"),
    ("null_rate:product_key", "SELECT CASE WHEN count(*) FILTER (product_key IS NULL) > count(*) * 0.01 THEN count(*) FILTER (product_key IS NULL) ELSE 0 END FROM kept"),
))
def gate_fact(r: Relations) -> DataFrame:
    return quality.fact_checks(kept(r), "sale_key", "product_key", {"null_product_key": F.col("product_key").isNull(), "negative_amount": F.col("amount") < 0}, r.sales)


@query("gate_temporal_mapping", "QG7 J4 A7", f"WITH {SQL_PROFILE}, st AS (SELECT *, CASE WHEN order_id % 50 = 1 THEN NULL ELSE version_key END AS stored FROM prof) " + checks(
    ("valid_date", "SELECT count(*) FROM st WHERE ordered IS NULL"), ("no_overlap", "SELECT count(*) FROM st WHERE matches > 1"), ("exact_key", "SELECT count(*) FROM st WHERE stored IS DISTINCT FROM version_key"),
    ("null_key", "SELECT count(*) FROM st WHERE part_id IS NULL"), ("key_has_version", "SELECT count(*) FROM st WHERE first_from IS NULL"), ("explained", "SELECT count(*) FROM st WHERE matches = 0 AND ordered >= first_from"),
))
def gate_temporal_mapping(r: Relations) -> DataFrame:
    stored = _with_part(r, r.sales, "ordered").select(*FACT_ID, F.when(F.col("order_id") % 50 != 1, F.col("product_key")).alias("stored")).distinct()
    return mapping_checks(sales_profile(r), stored, FACT_ID, "stored")


@query("gate_domain", "QG10 P12 P15", checks(
    ("accepted_values:o_orderstatus", "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"), ("accepted_values:o_orderpriority", "SELECT count(*) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"),
    ("domain:status", "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderkey % 2 = 0)"),
))
def gate_domain(r: Relations) -> DataFrame:
    orders = r.table("orders")
    known = orders.where("o_orderkey % 2 = 0").select("o_orderstatus").distinct()
    return quality.union([
        quality.accepted(orders, "o_orderstatus", ["F", "O"]), quality.accepted(orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
        quality.relationship(orders, "o_orderstatus", known, "o_orderstatus", "domain:status"),
    ])


@query("gate_fk", "QG10 J8", checks(
    ("customer", "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"), ("building_customer", "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"),
    ("part", "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)"), ("nation", "SELECT count(*) FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)"),
))
def gate_fk(r: Relations) -> DataFrame:
    orders, customer = r.table("orders"), r.table("customer")
    return quality.union([
        quality.relationship(orders, "o_custkey", customer, "c_custkey", "customer"), quality.relationship(orders, "o_custkey", customer.where("c_mktsegment = 'BUILDING'"), "c_custkey", "building_customer"),
        quality.relationship(r.table("lineitem"), "l_partkey", r.table("part"), "p_partkey", "part"), quality.relationship(r.table("supplier"), "s_nationkey", r.table("nation").where("n_regionkey < 3"), "n_nationkey", "nation"),
    ])


@query("gate_hierarchy", "QG11", """SELECT 'level_name' AS "check", count(*)::BIGINT AS failures, count(*) = 0 AS passed FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) ON n_regionkey = r_regionkey WHERE r_name IS NULL OR n_name IS NULL""")
def gate_hierarchy(r: Relations) -> DataFrame:
    tree = r.table("nation").join(r.table("region").where("r_regionkey <> 2"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return quality.row_checks(tree, {"level_name": F.col("r_name").isNull() | F.col("n_name").isNull()})


@query("gate_one_current", "QG3 A2", f"WITH {SQL_USERS} " + checks(("at_most_one_current", "SELECT count(*) FROM (SELECT user_id FROM users WHERE valid_to IS NULL GROUP BY 1 HAVING count(*) > 1)"), ("is_current_known", "SELECT 0")))
def gate_one_current(r: Relations) -> DataFrame:
    return quality.one_current(r.user_versions, "user_id")


@query("gate_reconcile_eligible", "QG9 J1 J8", f"WITH {SQL_KEPT}, el AS (SELECT * FROM sales WHERE quantity > 1) " + checks(
    ("missing", "SELECT count(*) FROM (SELECT order_id, line, part_id, supplier_id FROM el) e WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.order_id = e.order_id AND k.line = e.line AND k.part_id = e.part_id AND k.supplier_id = e.supplier_id)"),
    ("extra", "SELECT count(*) FROM kept k WHERE NOT EXISTS (SELECT 1 FROM el e WHERE k.order_id = e.order_id AND k.line = e.line AND k.part_id = e.part_id AND k.supplier_id = e.supplier_id)"),
))
def gate_reconcile(r: Relations) -> DataFrame:
    return quality.reconcile(r.sales.where("quantity > 1"), kept(r), FACT_ID)


@query("gate_orphan_provenance", "QG9 J8", f"""WITH {SQL_LINES}, h AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 6 <> 5), v AS (SELECT o_orderkey FROM h WHERE o_orderstatus <> 'P')
SELECT CASE WHEN h.o_orderkey IS NULL THEN 'not_in_source' ELSE 'rejected' END AS cause, count(*)::BIGINT AS lines, count(DISTINCT order_id)::BIGINT AS parents FROM lines LEFT JOIN v ON order_id = v.o_orderkey LEFT JOIN h ON order_id = h.o_orderkey WHERE v.o_orderkey IS NULL GROUP BY ALL""")
def gate_orphans(r: Relations) -> DataFrame:
    raw = r.orders.where("o_orderkey % 6 <> 5")
    return quality.orphans(r.lines, "order_id", raw.where("o_orderstatus <> 'P'"), raw, "o_orderkey")


@query("dbt_generic_suite", "QG12", checks(
    ("not_null:o_orderkey", "SELECT count(*) FROM orders WHERE o_orderkey IS NULL"), ("not_null:o_custkey", "SELECT count(*) FROM orders WHERE o_custkey IS NULL"), ("unique:o_orderkey", "SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)"),
    ("unique:l_orderkey,l_linenumber", "SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)"), ("accepted_values:l_returnflag", "SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')"),
    ("relationship:o_custkey", "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
))
def generic_suite(r: Relations) -> DataFrame:
    orders, lines = r.table("orders"), r.table("lineitem")
    return quality.union([
        quality.not_null(orders, "o_orderkey", "o_custkey"), quality.unique(orders, "o_orderkey"), quality.unique(lines, "l_orderkey", "l_linenumber"),
        quality.accepted(lines, "l_returnflag", ["A", "N"]), quality.relationship(orders, "o_custkey", r.table("customer"), "c_custkey"),
    ])


SQL_COST = f"""{SQL_SALES}, {SQL_PARTS}, pr AS (SELECT sales.*, version_key FROM {pit('sales', 'sales.part_id', 'ordered')}), cost AS (SELECT version_key, (sum(amount) FILTER (amount > 0))::DECIMAL(24,2) AS s, (count(*) FILTER (amount > 0))::BIGINT AS n FROM pr WHERE version_key IS NOT NULL GROUP BY 1)"""


def _priced(r: Relations) -> tuple[DataFrame, DataFrame]:
    """Sales with their version, and the sum and number of positive amounts a version: means are compared without dividing."""
    priced = _with_part(r, r.sales, "ordered")
    positive = F.when(F.col("amount") > 0, F.col("amount"))
    cost = priced.where("product_key IS NOT NULL").groupBy(F.col("product_key").alias("_k")).agg(F.sum(positive).cast("decimal(24,2)").alias("s"), F.count(positive).alias("n"))
    return priced, cost


@query("offer_below_mean_cost", "QG13 A8", f"WITH {SQL_COST} SELECT order_id, line, part_id, supplier_id, amount FROM pr JOIN cost USING (version_key) WHERE amount * n * 10 < s AND l_returnflag = 'N'")
def offer_below_mean(r: Relations) -> DataFrame:
    priced, cost = _priced(r)
    return priced.where("l_returnflag = 'N'").join(cost, F.col("product_key") == F.col("_k")).where(F.col("amount") * F.col("n") * 10 < F.col("s")).select(*FACT_ID, "amount")


@query("promo_below_mean_cost", "QG13 A8", f"WITH {SQL_COST} SELECT order_id, line, part_id, supplier_id, amount FROM pr JOIN cost USING (version_key) WHERE amount * n * 5 < s AND o_orderpriority LIKE '1%'")
def promo_below_mean(r: Relations) -> DataFrame:
    priced, cost = _priced(r)
    return priced.where(F.startswith("o_orderpriority", F.lit("1"))).join(cost, F.col("product_key") == F.col("_k")).where(F.col("amount") * F.col("n") * 5 < F.col("s")).select(*FACT_ID, "amount")


@query("offer_above_normal", "QG13", f"WITH {SQL_LINES} SELECT order_id, line, part_id, supplier_id, amount FROM lines JOIN part ON part_id = p_partkey WHERE amount > CAST(p_retailprice AS DECIMAL(14,2)) * 100")
def offer_above_normal(r: Relations) -> DataFrame:
    return r.lines.join(r.table("part"), F.col("part_id") == F.col("p_partkey")).where(F.col("amount") > F.col("p_retailprice").cast("decimal(14,2)") * 100).select(*FACT_ID, "amount")


@query("zero_value_with_qty", "QG13", f"WITH {SQL_LINES} SELECT order_id, line, part_id, supplier_id, quantity FROM lines WHERE discount = 0 AND quantity > 45")
def zero_value(r: Relations) -> DataFrame:
    return r.lines.where("discount = 0 AND quantity > 45").select(*FACT_ID, "quantity")


@query("calendar_fk", "QG13 J8", """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS day_key, count(*)::BIGINT AS n FROM orders WHERE year(o_orderdate) NOT BETWEEN 1996 AND 1999 GROUP BY ALL""")
def calendar_fk(r: Relations) -> DataFrame:
    days = calendar(r.spark, "1996-01-01", "1999-12-31").select("day_key")
    facts = r.orders.select(F.date_format("ordered", "yyyyMMdd").cast("int").alias("day_key"))
    return facts.join(days, "day_key", "left_anti").groupBy("day_key").agg(F.count(F.lit(1)).alias("n"))


@query("one_active_version", "QG13 A2", f"WITH {SQL_PARTS} SELECT part_id, count(*)::BIGINT AS n FROM parts WHERE is_current OR lines > 3 GROUP BY part_id HAVING count(*) > 1")
def one_active_version(r: Relations) -> DataFrame:
    return r.part_versions.where("is_current OR lines > 3").groupBy("part_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("bronze_gate", "QG1 A1 A5", "WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events), l AS (SELECT max(day) AS d FROM e) " + checks(
    ("recency", "SELECT CASE WHEN DATE '2024-02-01' - d > 1 THEN 1 ELSE 0 END FROM l"), ("null_key", "SELECT count(*) FROM e WHERE user_id IS NULL"), ("null_day", "SELECT count(*) FROM e WHERE day IS NULL"),
    ("repeated_in_last_day", "SELECT count(*) FROM (SELECT user_id FROM e, l WHERE day = d GROUP BY user_id HAVING count(*) > 1)"),
))
def bronze_gate(r: Relations) -> DataFrame:
    return quality.raw_gate(r.table("events").select("user_id", F.to_date("ts").alias("day")), "user_id", "day", "2024-02-01", 1)


@query("watchdog_status", "QG2 QG14 J10", """WITH c AS (SELECT event_type AS entity, max(CAST(ts AS TIMESTAMP)) AS seen_at FROM events WHERE event_type <> 'click' AND (event_type <> 'view' OR day(ts) < 20) GROUP BY 1), x AS (SELECT unnest(['click', 'view', 'purchase', 'signup']) AS entity)
SELECT coalesce(x.entity, c.entity) AS entity, date_diff('day', CAST(seen_at AS DATE), DATE '2024-01-31')::INT AS age_days, CASE WHEN c.entity IS NULL THEN 'missing' WHEN x.entity IS NULL THEN 'unexpected' WHEN date_diff('day', CAST(seen_at AS DATE), DATE '2024-01-31') > 2 THEN 'stale' ELSE 'ok' END AS status FROM x FULL JOIN c ON x.entity = c.entity""")
def watchdog(r: Relations) -> DataFrame:
    control = r.table("events").where("event_type <> 'click' AND (event_type <> 'view' OR day(ts) < 20)").groupBy(F.col("event_type").alias("entity")).agg(F.max("ts").alias("at"))
    expected = r.spark.createDataFrame([("click",), ("view",), ("purchase",), ("signup",)], "entity string")
    return quality.freshness(control, expected, "2024-01-31", 2)


@query("baseline_equivalence", "PR11 PR6 SCD11", f"""WITH {SQL_KEPT}, a AS (SELECT DISTINCT order_id, line, part_id, supplier_id, amount FROM kept), b AS (SELECT DISTINCT order_id, line, part_id, supplier_id, CASE WHEN order_id % 11 = 0 THEN amount + 1 ELSE amount END AS amount FROM sales)
SELECT count(*) FILTER (a.order_id IS NULL) AS missing, count(*) FILTER (b.order_id IS NULL) AS extra, count(*) FILTER (a.amount <> b.amount) AS changed, count(*) FILTER (a.amount = b.amount) AS same FROM a FULL JOIN b USING (order_id, line, part_id, supplier_id)""")
def baseline_equivalence(r: Relations) -> DataFrame:
    from ..operators.profile import key_deltas

    now = r.sales.select(*FACT_ID, F.when(F.col("order_id") % 11 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(14,2)").alias("amount"))
    return key_deltas(kept(r).select(*FACT_ID, "amount").distinct(), now.distinct(), FACT_ID)
