"""Star-schema models: dimensions and facts with point-in-time keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hashed
from ..operators.running import running
from ..operators.temporal import match_profile, point_in_time_join
from .registry import query
from .relations import SQL_LINES, SQL_ORDERS, SQL_PARTS, SQL_SALES, SQL_USERS, Relations, pit

text = lambda c: F.col(c).cast("string").alias(c)


def calendar(spark: SparkSession, first: str = "2023-01-01", last: str = "2027-12-31") -> DataFrame:
    """A row a day with its attributes; the key is the day as yyyyMMdd."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    season = F.when(F.month("day").isin(12, 1, 2), "summer").when(F.month("day").isin(3, 4, 5), "autumn").when(F.month("day").isin(6, 7, 8), "winter").otherwise("spring")
    return days.select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("day_key"), "day", F.year("day").alias("year"), F.month("day").alias("month"), F.dayofmonth("day").alias("day_of_month"), F.quarter("day").alias("quarter"),
        F.weekofyear("day").alias("week"), F.dayofweek("day").alias("day_of_week"), F.date_format("day", "MMMM").alias("month_name"), F.date_format("day", "EEEE").alias("day_name"), F.date_format("day", "MMM/yyyy").alias("month_label"),
        F.dayofweek("day").isin(1, 7).alias("is_weekend"), season.alias("southern_season"),
    )


def day_key(c: str):
    return F.date_format(c, "yyyyMMdd").cast("int")


@query("dim_calendar", "G1 P10 S8", """
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS day_key, CAST(CAST(d AS DATE) AS VARCHAR) AS day, year(d)::INT AS year, month(d)::INT AS month, day(d)::INT AS day_of_month, quarter(d)::INT AS quarter, week(d)::INT AS week,
  (dayofweek(d) + 1)::INT AS day_of_week, strftime(d, '%B') AS month_name, strftime(d, '%A') AS day_name, strftime(d, '%b/%Y') AS month_label, dayofweek(d) IN (0, 6) AS is_weekend,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'summer' WHEN month(d) IN (3, 4, 5) THEN 'autumn' WHEN month(d) IN (6, 7, 8) THEN 'winter' ELSE 'spring' END AS southern_season
FROM generate_series(DATE '2023-01-01', DATE '2027-12-31', INTERVAL 1 DAY) t(d)""")
def dim_calendar(r: Relations) -> DataFrame:
    return calendar(r.spark).withColumn("day", F.col("day").cast("string"))


@query("dim_product_history", "G2 G4 J2", f"""WITH {SQL_PARTS}, brands AS (SELECT DISTINCT p_brand FROM part), b AS (SELECT p_brand, dense_rank() OVER (ORDER BY p_brand)::INT AS brand_id FROM brands)
SELECT version_key, part_id, trim(p_name) AS name, brand_id, trim(p_type) AS type, flag, status, lines, valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to, is_current
FROM parts LEFT JOIN part ON part_id = p_partkey LEFT JOIN b USING (p_brand)""")
def dim_product_history(r: Relations) -> DataFrame:
    part = r.table("part")
    brands = running(r.spark, part.select(F.lit(0).alias("_all"), F.col("p_brand").alias("_brand")).where("_brand IS NOT NULL").distinct(), ["_all"], ["_brand"], F.lit(1), r.folder("brands"))
    brands = brands.select("_brand", F.col("running").cast("int").alias("brand_id"))
    named = part.join(brands, F.col("p_brand") == F.col("_brand"), "left")
    out = r.part_versions.join(named, F.col("part_id") == F.col("p_partkey"), "left")
    return out.select("version_key", "part_id", F.trim("p_name").alias("name"), "brand_id", F.trim("p_type").alias("type"), "flag", "status", "lines", text("valid_from"), text("valid_to"), "is_current")


@query("dim_supplier_history", "G3 SCD4", f"""WITH {SQL_USERS}
SELECT md5(concat_ws('||', user_id::VARCHAR, valid_from::VARCHAR)) AS version_key, user_id, kind, events, valid_from::VARCHAR AS valid_from, valid_to::VARCHAR AS valid_to, valid_from_source, valid_to IS NULL AS is_current FROM users""")
def dim_supplier_history(r: Relations) -> DataFrame:
    return r.user_versions.select("version_key", "user_id", "kind", "events", text("valid_from"), text("valid_to"), "valid_from_source", "is_current")


@query("dim_product_hierarchy", "G2 G4 J6", """
SELECT n_nationkey AS node_id, trim(n_name) AS level2, r_regionkey AS parent_id, trim(r_name) AS level1, md5(concat_ws('||', r_regionkey::VARCHAR, n_nationkey::VARCHAR)) AS path_key FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
def dim_product_hierarchy(r: Relations) -> DataFrame:
    region = F.broadcast(r.table("region"))  # a fixed domain of five rows
    out = r.table("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select(F.col("n_nationkey").alias("node_id"), F.trim("n_name").alias("level2"), F.col("r_regionkey").alias("parent_id"), F.trim("r_name").alias("level1"), hashed("r_regionkey", "n_nationkey").alias("path_key"))


@query("dim_domains_conformed", "G5 G6 G7 G8 G9 O4", """
WITH d AS (SELECT DISTINCT 'status' AS domain, o_orderstatus AS code FROM orders UNION SELECT DISTINCT 'priority', o_orderpriority FROM orders UNION SELECT DISTINCT 'return', l_returnflag FROM lineitem
  UNION SELECT DISTINCT 'event', event_type FROM events UNION SELECT DISTINCT 'segment', c_mktsegment FROM customer)
SELECT domain, code, dense_rank() OVER (PARTITION BY domain ORDER BY code)::INT AS code_id, trim(code) AS description FROM d""")
def dim_domains(r: Relations) -> DataFrame:
    from pyspark.sql import Window

    sources = {"status": ("orders", "o_orderstatus"), "priority": ("orders", "o_orderpriority"), "return": ("lineitem", "l_returnflag"), "event": ("events", "event_type"), "segment": ("customer", "c_mktsegment")}
    out = None
    for domain, (table, column) in sources.items():
        one = r.table(table).select(F.lit(domain).alias("domain"), F.col(column).alias("code")).distinct()
        out = one if out is None else out.unionByName(one)
    return out.select("domain", "code", F.dense_rank().over(Window.partitionBy("domain").orderBy("code")).alias("code_id"), F.trim("code").alias("description"))


@query("dim_promotion", "G10 J2", f"""WITH {SQL_ORDERS}, s AS (SELECT DISTINCT o_orderstatus AS code FROM orders), s2 AS (SELECT code, row_number() OVER (ORDER BY code)::INT AS id FROM s)
SELECT o_orderkey AS promotion_id, id AS status_id, trim(o_orderpriority) AS kind, total, ordered::VARCHAR AS starts FROM ord LEFT JOIN s2 ON o_orderstatus = code WHERE o_orderpriority LIKE '1%'""")
def dim_promotion(r: Relations) -> DataFrame:
    from pyspark.sql import Window

    codes = r.orders.select(F.col("o_orderstatus").alias("code")).distinct().select("code", F.row_number().over(Window.orderBy("code")).alias("status_id"))
    heads = r.orders.where(F.startswith("o_orderpriority", F.lit("1"))).join(F.broadcast(codes), F.col("o_orderstatus") == F.col("code"), "left")
    return heads.select(F.col("o_orderkey").alias("promotion_id"), "status_id", F.trim("o_orderpriority").alias("kind"), "total", F.col("ordered").cast("string").alias("starts"))


def _with_part(r: Relations, facts: DataFrame, event: str) -> DataFrame:
    return point_in_time_join(facts, r.part_versions, "part_id", event, "part_id", {"version_key": "product_key"})


@query("pit_sales_by_version", "J1 J3 W2 W3 SCD1 G11", f"""WITH {SQL_SALES}, {SQL_PARTS}
SELECT version_key AS product_key, year(ordered)::INT AS year, sum(amount)::DECIMAL(24,2) AS revenue, sum(quantity)::DECIMAL(24,3) AS quantity, count(*)::BIGINT AS n FROM {pit('sales', 'sales.part_id', 'ordered')} GROUP BY ALL""")
def pit_sales_by_version(r: Relations) -> DataFrame:
    out = _with_part(r, r.sales, "ordered")
    return out.groupBy("product_key", F.year("ordered").alias("year")).agg(F.sum("amount").alias("revenue"), F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n"))


@query("fact_sales", "G11 J3", f"""WITH {SQL_SALES}, {SQL_PARTS}
SELECT md5(concat_ws('||', order_id::VARCHAR, line::VARCHAR, sales.part_id::VARCHAR, supplier_id::VARCHAR)) AS sale_key, version_key AS product_key, CAST(strftime(ordered, '%Y%m%d') AS INT) AS day_key, order_id, quantity, amount, year(ordered)::INT AS year, month(ordered)::INT AS month
FROM {pit('sales', 'sales.part_id', 'ordered')}""")
def fact_sales(r: Relations) -> DataFrame:
    return _with_part(r, r.sales, "ordered").select(hashed("order_id", "line", "part_id", "supplier_id").alias("sale_key"), "product_key", day_key("ordered").alias("day_key"), "order_id", "quantity", "amount", F.year("ordered").alias("year"), F.month("ordered").alias("month"))


@query("fact_purchases", "G12 J1 J2 J3", f"""WITH {SQL_SALES}, {SQL_PARTS}, {SQL_USERS}
SELECT order_id, line, sales.part_id, supplier_id, v.version_key AS product_key, md5(concat_ws('||', w.user_id::VARCHAR, w.valid_from::VARCHAR)) AS party_key, trim(o_orderstatus) AS status, quantity, amount
FROM {pit('sales', 'sales.part_id', 'ordered')} LEFT JOIN users w ON supplier_id = w.user_id AND ordered + INTERVAL 25 YEAR >= w.valid_from AND (w.valid_to IS NULL OR ordered + INTERVAL 25 YEAR < w.valid_to)""".replace(
    "md5(concat_ws('||', w.user_id::VARCHAR, w.valid_from::VARCHAR)) AS party_key", "CASE WHEN w.user_id IS NOT NULL THEN md5(concat_ws('||', w.user_id::VARCHAR, w.valid_from::VARCHAR)) END AS party_key"))
def fact_purchases(r: Relations) -> DataFrame:
    facts = _with_part(r, r.sales, "ordered").withColumn("moved", F.expr("ordered + INTERVAL 25 YEAR"))
    out = point_in_time_join(facts, r.user_versions, "supplier_id", "moved", "user_id", {"version_key": "party_key"})
    return out.select("order_id", "line", "part_id", "supplier_id", "product_key", "party_key", F.trim("o_orderstatus").alias("status"), "quantity", "amount")


@query("fact_losses", "G13 J3", f"""WITH {SQL_LINES}, {SQL_PARTS}
SELECT md5(concat_ws('||', order_id::VARCHAR, line::VARCHAR, lines.part_id::VARCHAR, supplier_id::VARCHAR)) AS loss_key, version_key AS product_key, CAST(strftime(shipped, '%Y%m%d') AS INT) AS day_key, quantity, l_returnflag AS reason
FROM {pit('lines', 'lines.part_id', 'shipped')} WHERE l_returnflag = 'R'""".replace("pn.lines", "pn.lines"))
def fact_losses(r: Relations) -> DataFrame:
    lost = r.lines.where("l_returnflag = 'R'")
    return _with_part(r, lost, "shipped").select(hashed("order_id", "line", "part_id", "supplier_id").alias("loss_key"), "product_key", day_key("shipped").alias("day_key"), "quantity", F.col("l_returnflag").alias("reason"))


@query("fact_stock_movement", "G14 P11 W2", """
WITH e AS (SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, CAST(value AS DECIMAL(14,2)) AS v, event_type FROM events),
b AS (SELECT *, coalesce(sum(v) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DECIMAL(24,2) AS stock_before, (sum(v) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::DECIMAL(24,2) AS stock_after FROM e)
SELECT event_id, user_id, event_type AS movement, stock_before, stock_after, (stock_after - stock_before)::DECIMAL(24,2) AS variation FROM b""")
def fact_stock_movement(r: Relations) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = r.table("events").withColumn("v", F.col("value").cast("decimal(14,2)"))
    before = F.coalesce(F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(24,2)")
    e = e.select("event_id", "user_id", F.col("event_type").alias("movement"), before.alias("stock_before"), F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(24,2)").alias("stock_after"))
    return e.withColumn("variation", (F.col("stock_after") - F.col("stock_before")).cast("decimal(24,2)"))


@query("fact_promotions", "G15 J1 J3", f"""WITH {SQL_SALES}, {SQL_PARTS}
SELECT order_id AS promotion_id, line, sales.part_id, version_key AS product_key, amount AS price FROM {pit('sales', 'sales.part_id', 'ordered')} WHERE o_orderpriority LIKE '1%'""")
def fact_promotions(r: Relations) -> DataFrame:
    return _with_part(r, r.sales.where(F.startswith("o_orderpriority", F.lit("1"))), "ordered").select(F.col("order_id").alias("promotion_id"), "line", "part_id", "product_key", F.col("amount").alias("price"))


@query("fact_offer_discount", "G16 P10 P11", f"""WITH {SQL_LINES}
SELECT order_id, line, part_id, supplier_id, CAST(p_retailprice AS DECIMAL(14,2)) AS normal, amount AS offered, (CAST(p_retailprice AS DECIMAL(14,2)) - discount)::DECIMAL(15,2) AS offer_price,
  CASE WHEN p_retailprice > 0 THEN discount * 100 END::DECIMAL(18,2) AS discount_percent, CASE WHEN amount > CAST(p_retailprice AS DECIMAL(14,2)) THEN 'above' ELSE 'within' END AS band FROM lines JOIN part ON part_id = p_partkey""")
def fact_offer_discount(r: Relations) -> DataFrame:
    normal = F.col("p_retailprice").cast("decimal(14,2)")
    out = r.lines.join(r.table("part"), F.col("part_id") == F.col("p_partkey"))
    return out.select(
        "order_id", "line", "part_id", "supplier_id", normal.alias("normal"), F.col("amount").alias("offered"), (normal - F.col("discount")).cast("decimal(15,2)").alias("offer_price"),
        F.when(normal > 0, F.col("discount") * 100).cast("decimal(18,2)").alias("discount_percent"), F.when(F.col("amount") > normal, "above").otherwise("within").alias("band"),
    )


@query("fact_payables_roles", "G17 J1", f"""WITH {SQL_SALES}
SELECT order_id, line, part_id, supplier_id, CAST(strftime(ordered, '%Y%m%d') AS INT) AS issued_key, CASE WHEN l_linestatus = 'F' THEN CAST(strftime(shipped, '%Y%m%d') AS INT) END AS paid_key, amount FROM sales""")
def fact_payables(r: Relations) -> DataFrame:
    return r.sales.select("order_id", "line", "part_id", "supplier_id", day_key("ordered").alias("issued_key"), F.when(F.col("l_linestatus") == "F", day_key("shipped")).alias("paid_key"), "amount")


@query("fact_optional_party", "G18 J3", f"""WITH {SQL_LINES}, {SQL_PARTS}, f AS (SELECT order_id, line, supplier_id, lines.part_id AS real_part, CASE WHEN l_returnflag = 'N' THEN NULL ELSE lines.part_id END AS party, shipped, amount FROM lines)
SELECT order_id, line, supplier_id, real_part, party, version_key AS party_key, amount FROM {pit('f', 'f.party', 'shipped')}""")
def fact_optional_party(r: Relations) -> DataFrame:
    facts = r.lines.withColumn("real_part", F.col("part_id")).withColumn("party", F.when(F.col("l_returnflag") != "N", F.col("part_id"))).drop("part_id")
    out = point_in_time_join(facts, r.part_versions, "party", "shipped", "part_id", {"version_key": "party_key"})
    return out.select("order_id", "line", "supplier_id", "real_part", "party", "party_key", "amount")


@query("fact_abc_snapshot", "G19 A10 J7 W1", f"""WITH {SQL_LINES}, {SQL_PARTS}, y AS (SELECT lines.part_id, make_date(year(shipped)::INT, 12, 31) AS snapshot_date, sum(amount)::DECIMAL(24,2) AS revenue FROM lines GROUP BY ALL),
c AS (SELECT *, sum(revenue) OVER (PARTITION BY snapshot_date ORDER BY revenue DESC, part_id ROWS UNBOUNDED PRECEDING) AS running, sum(revenue) OVER (PARTITION BY snapshot_date) AS total FROM y),
k AS (SELECT *, CASE WHEN running * 10 <= total * 8 THEN 1 WHEN running * 100 <= total * 95 THEN 2 ELSE 3 END AS class_id FROM c)
SELECT k.part_id, k.snapshot_date::VARCHAR AS snapshot_date, v.version_key AS product_key, revenue, CASE class_id WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE 'C' END AS class FROM {pit('k', 'k.part_id', 'CAST(k.snapshot_date AS TIMESTAMP)')}""")
def fact_abc_snapshot(r: Relations) -> DataFrame:
    yearly = r.lines.groupBy("part_id", F.make_date(F.year("shipped"), F.lit(12), F.lit(31)).alias("snapshot_date")).agg(F.sum("amount").alias("revenue"))
    summed = running(r.spark, yearly, ["snapshot_date"], [F.desc("revenue"), "part_id"], F.col("revenue"), r.folder("yearly"))
    cut = F.when(F.col("running") * 10 <= F.col("total") * 8, 1).when(F.col("running") * 100 <= F.col("total") * 95, 2).otherwise(3)
    classes = r.spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id int, name string").agg(F.map_from_entries(F.collect_list(F.struct("id", "name"))).alias("classes"))
    marked = summed.withColumn("class_id", cut).withColumn("at", F.col("snapshot_date").cast("timestamp")).join(F.broadcast(classes), F.lit(True))
    out = point_in_time_join(marked, r.part_versions, "part_id", "at", "part_id", {"version_key": "product_key"})
    return out.select("part_id", F.col("snapshot_date").cast("string").alias("snapshot_date"), "product_key", F.col("revenue").cast("decimal(24,2)").alias("revenue"), F.try_element_at("classes", F.col("class_id")).alias("class"))


FACT_ID = ["order_id", "line", "part_id", "supplier_id"]


def sales_profile(r: Relations) -> DataFrame:
    return match_profile(r.sales.withColumn("fk", F.col("part_id")), r.part_versions, FACT_ID, "fk", "ordered", "part_id")


SQL_PROFILE = f"""{SQL_SALES}, {SQL_PARTS}, prof AS (SELECT order_id, line, sales.part_id, supplier_id, ordered, count(*) FILTER (ordered >= v.valid_from AND (v.valid_to IS NULL OR ordered < v.valid_to)) AS matches,
  max(CASE WHEN ordered >= v.valid_from AND (v.valid_to IS NULL OR ordered < v.valid_to) THEN version_key END) AS version_key, max(CASE WHEN is_current THEN version_key END) AS current_key, min(v.valid_from) AS first_from
  FROM sales LEFT JOIN parts v ON sales.part_id = v.part_id GROUP BY ALL)"""


@query("pit_unresolved_profile", "QG7 PR12 PR13 A6", f"""WITH {SQL_PROFILE}, w AS (SELECT CASE WHEN matches > 0 THEN 'matched' WHEN first_from IS NULL THEN 'no_version' WHEN ordered < first_from THEN 'before_first' ELSE 'gap' END AS reason, date_diff('day', CAST(ordered AS DATE), CAST(first_from AS DATE)) AS before FROM prof)
SELECT reason, count(*)::BIGINT AS n, (max(before) FILTER (reason = 'before_first'))::INT AS most_days, (quantile_disc(before, 0.5) FILTER (reason = 'before_first'))::INT AS median_days FROM w GROUP BY reason""")
def pit_unresolved(r: Relations) -> DataFrame:
    days = F.when(F.col("reason") == "before_first", F.datediff(F.to_date("first_from"), F.to_date("event")))
    return sales_profile(r).withColumn("days", days).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.max("days").alias("most_days"), F.percentile_approx("days", 0.5, 1_000_000).alias("median_days"))


@query("pit_overlap_check", "QG7 A2", f"WITH {SQL_PROFILE} SELECT count(*)::BIGINT AS facts, count(*) FILTER (matches > 1) AS overlapping FROM prof")
def pit_overlap(r: Relations) -> DataFrame:
    return sales_profile(r).agg(F.count(F.lit(1)).alias("facts"), F.count_if(F.col("matches") > 1).alias("overlapping"))


@query("pit_vs_current_key", "J5 PR12", f"""WITH {SQL_PROFILE} SELECT year(ordered)::INT AS year, count(*)::BIGINT AS facts, count(*) FILTER (version_key IS DISTINCT FROM current_key) AS moved FROM prof GROUP BY ALL""")
def pit_vs_current(r: Relations) -> DataFrame:
    return sales_profile(r).groupBy(F.year("event").alias("year")).agg(F.count(F.lit(1)).alias("facts"), F.count_if(~F.col("version_key").eqNullSafe(F.col("current_key"))).alias("moved"))
