"""The relations that queries start from, as DataFrames and as SQL: a sales fact and two dimensions with history."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import hashed
from ..functions.typing import money
from ..operators.history import HistoryPolicy, backfill
from ..sources.workspace import shared_folder

PARTS = HistoryPolicy("part_id", ("flag", "status"), ("lines",))
USERS = HistoryPolicy("user_id", ("kind",), ("events",), snapshot="day", initial="first_ts", compare="date")


class Relations:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        """A driver table; timestamps get the session's zone, UTC."""
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.simpleString() == "timestamp_ntz" else F.col(f.name) for f in df.schema])

    @functools.cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", money("o_totalprice").alias("total"), F.col("o_orderdate").alias("ordered"))

    @functools.cached_property
    def lines(self) -> DataFrame:
        cols = {"l_orderkey": "order_id", "l_linenumber": "line", "l_partkey": "part_id", "l_suppkey": "supplier_id"}
        names = [F.col(a).alias(b) for a, b in cols.items()]
        return self.table("lineitem").select(*names, money("l_quantity", 3).alias("quantity"), money("l_extendedprice").alias("amount"), money("l_discount").alias("discount"), "l_returnflag", "l_linestatus", F.col("l_shipdate").alias("shipped"))

    @functools.cached_property
    def sales(self) -> DataFrame:
        """Order lines with their header; the header's date is the business date."""
        return self.lines.join(self.orders, F.col("order_id") == F.col("o_orderkey"))

    @functools.cached_property
    def part_snapshots(self) -> DataFrame:
        """A row a part and year: the state the year's lines show."""
        year = F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1))
        return self.table("lineitem").groupBy(F.col("l_partkey").alias("part_id"), year.alias("snapshot")).agg(F.max("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status"), F.count(F.lit(1)).alias("lines"))

    @functools.cached_property
    def user_snapshots(self) -> DataFrame:
        """A row a user and day: the last event's type, the number of events, the first time."""
        day = F.to_date("ts").alias("day")
        return self.table("events").groupBy("user_id", day).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("kind"), F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_ts"))

    @functools.cached_property
    def part_versions(self) -> DataFrame:
        return backfill(self.part_snapshots, PARTS).withColumn("version_key", hashed("part_id", "valid_from"))

    @functools.cached_property
    def user_versions(self) -> DataFrame:
        return backfill(self.user_snapshots, USERS).withColumn("version_key", hashed("user_id", "valid_from"))

    def folder(self, name: str) -> str:
        """A new folder that the driver and all executors share."""
        return f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex[:12]}"


def first_by(df: DataFrame, keys: list[str], *order) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_r", rank).where("_r = 1").drop("_r")


# --- the same in SQL: common table expressions to join with commas

SQL_ORDERS = """ord AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(14,2)) AS total, CAST(o_orderdate AS TIMESTAMP) AS ordered FROM orders)"""
SQL_LINES = """lines AS (SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, l_suppkey AS supplier_id, CAST(l_quantity AS DECIMAL(14,3)) AS quantity,
  CAST(l_extendedprice AS DECIMAL(14,2)) AS amount, CAST(l_discount AS DECIMAL(14,2)) AS discount, l_returnflag, l_linestatus, CAST(l_shipdate AS TIMESTAMP) AS shipped FROM lineitem)"""
SQL_SALES = f"{SQL_ORDERS}, {SQL_LINES}, sales AS (SELECT * FROM lines JOIN ord ON order_id = o_orderkey)"
SQL_PART_SNAPSHOTS = """psnap AS (SELECT l_partkey AS part_id, make_date(year(l_shipdate)::INT, 1, 1) AS snapshot, max(l_returnflag) AS flag, min(l_linestatus) AS status, count(*)::BIGINT AS lines FROM lineitem GROUP BY ALL)"""
SQL_PARTS = SQL_PART_SNAPSHOTS + """, ph AS (SELECT *, md5(concat_ws('||', coalesce(flag, '<NULL>'), coalesce(status, '<NULL>'))) AS version_hash FROM psnap),
pl AS (SELECT *, lag(version_hash) OVER (PARTITION BY part_id ORDER BY snapshot) AS prev FROM ph),
pv AS (SELECT *, CAST(snapshot AS TIMESTAMP) AS valid_from, lead(CAST(snapshot AS TIMESTAMP)) OVER (PARTITION BY part_id ORDER BY snapshot) AS valid_to FROM pl WHERE prev IS NULL OR prev <> version_hash),
pn AS (SELECT part_id, max_by(lines, snapshot) AS lines FROM psnap GROUP BY part_id),
parts AS (SELECT pv.part_id, flag, status, pn.lines, version_hash, valid_from, valid_to, valid_to IS NULL AS is_current, snapshot AS source_snapshot, md5(concat_ws('||', pv.part_id::VARCHAR, valid_from::VARCHAR)) AS version_key
  FROM pv JOIN pn USING (part_id))"""
SQL_USER_SNAPSHOTS = """ur AS (SELECT *, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events),
usnap AS (SELECT user_id, day, max(CASE WHEN rn = 1 THEN event_type END) AS kind, count(*)::BIGINT AS events, min(CAST(ts AS TIMESTAMP)) AS first_ts FROM ur GROUP BY ALL)"""
SQL_USERS = SQL_USER_SNAPSHOTS + """, uh AS (SELECT *, md5(coalesce(kind, '<NULL>')) AS version_hash FROM usnap),
ul AS (SELECT *, lag(version_hash) OVER (PARTITION BY user_id ORDER BY day) AS prev FROM uh),
uc AS (SELECT *, CASE WHEN prev IS NULL AND CAST(first_ts AS DATE) <= day THEN first_ts ELSE CAST(day AS TIMESTAMP) END AS valid_from,
  CASE WHEN prev IS NULL AND CAST(first_ts AS DATE) <= day THEN 'first_ts' ELSE 'snapshot' END AS valid_from_source FROM ul WHERE prev IS NULL OR prev <> version_hash),
un AS (SELECT user_id, max_by(events, day) AS events FROM usnap GROUP BY user_id),
users AS (SELECT uc.user_id, kind, un.events, version_hash, valid_from, lead(valid_from) OVER (PARTITION BY uc.user_id ORDER BY valid_from, day) AS valid_to, valid_from_source, day AS source_snapshot FROM uc JOIN un USING (user_id))"""


def pit(fact: str, key: str, event: str, versions: str = "parts", version_key: str = "part_id", alias: str = "v") -> str:
    return f"{fact} LEFT JOIN {versions} {alias} ON {key} = {alias}.{version_key} AND {event} >= {alias}.valid_from AND ({alias}.valid_to IS NULL OR {event} < {alias}.valid_to)"
