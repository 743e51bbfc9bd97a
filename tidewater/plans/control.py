"""The control plane as queries: schema registry, contract inventory, availability, replay and environment checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.contracts import inventory, structural_errors, validate
from ..operators.drift import DriftError, DriftRegistry, probe
from ..operators.incremental import COMMITTED, PENDING, Watermarks, pending_range
from ..operators.state import changed, latest, multiset_difference, upsert
from ..sources.store import VersionedTable
from .histories import last_days
from .registry import query
from .relations import SQL_LINES, SQL_PARTS, Relations
from .rules import EVENTS, LINES, NOW, ORDERS, events


@query("drift_registry_audit", "SD1 SD2 SD3 SD4 SD5 SD6 SD7 S14 P4 P5 P6", """SELECT * FROM (VALUES ('additive', 'additive', 1), ('mixed', 'mixed_breaking', 1), ('promoted', 'no_drift', 2), ('removed', 'removed_column', 1), ('same', 'no_drift', 1), ('unknown', 'missing_baseline', NULL), ('widened', 'type_change', 1)) t(entity, state, version)""")
def drift_registry_audit(r: Relations) -> DataFrame:
    """Every class of drift against accepted baselines; a breaking one is promoted explicitly. Schemas only, no rows are read."""
    registry, base = DriftRegistry(r.folder("drift"), r.spark), events(r)
    more, less, other = base.withColumn("extra", F.lit(1)), base.drop("amount"), base.withColumn("amount", F.col("amount").cast("string"))
    shapes = {"same": base, "additive": more, "removed": less, "widened": other, "mixed": less.withColumn("extra", F.lit(1)), "promoted": other, "unknown": base}
    for entity in sorted(shapes.keys() - {"unknown"}):
        registry.bootstrap(entity, probe(base, {}), "setup", "first")
    try:
        registry.evaluate("promoted", other)
    except DriftError as e:
        registry.promote(str(e).rpartition("(")[2].rstrip(")"), "review", "type agreed", breaking=True)
    return registry.audit(shapes)


@query("contract_inventory", "DC1 DC11", """SELECT * FROM (VALUES ('events', '', 'user_id', 4, 2, 0, 0), ('lines', '', 'order_id,line', 5, 2, 2, 1), ('orders', '', 'o_orderkey', 3, 1, 2, 2)) t("table", owner, grain, n_columns, n_required, n_rules, n_warnings)""")
def contract_inventory(r: Relations) -> DataFrame:
    return inventory(r.spark, [EVENTS, LINES, ORDERS])


@query("gate_silver_contracts", "QG4 QG5 O3", f"""WITH {SQL_LINES}, e AS (SELECT CAST(value AS DECIMAL(14,2)) AS amount, event_type FROM events)
SELECT 'events' AS table_name, 0 AS structural, (SELECT count(*) FROM e WHERE event_type NOT IN ('view', 'click', 'signup', 'purchase') OR amount < 1 OR amount > 200)::BIGINT AS quarantined, (SELECT count(*) > 0 FROM e) AS available
UNION ALL SELECT 'orders', 0, 0, (SELECT count(*) > 0 FROM orders) UNION ALL SELECT 'lines', 1, NULL, (SELECT count(*) > 0 FROM lines)""")
def gate_silver_contracts(r: Relations) -> DataFrame:
    """Structure, quarantine and availability of each table under contract; a table of the wrong structure isn't validated."""
    tables = {"events": (events(r), EVENTS), "orders": (r.orders, ORDERS), "lines": (r.lines.drop("supplier_id"), LINES)}
    out = None
    for name, (df, contract) in tables.items():
        errors = structural_errors(df, contract)
        bad = F.lit(None).cast("long") if errors else F.count(F.when(F.size("_reasons") > 0, 1))
        rows = df if errors else validate(df, contract, lambda _: r.table("customer"), now=NOW).marked
        one = rows.agg(F.lit(name).alias("table_name"), F.lit(len(errors)).alias("structural"), bad.alias("quarantined"), (F.count(F.lit(1)) > 0).alias("available"))
        out = one if out is None else out.unionByName(one)
    return out


@query("prior_versions", "J12 W5 P9 SCD8", f"""WITH {SQL_PARTS}, j AS (SELECT n.part_id, n.valid_from, p.valid_from AS prior_from, n.flag IS DISTINCT FROM p.flag AS flag_changed, row_number() OVER (PARTITION BY n.part_id, n.valid_from ORDER BY p.valid_from DESC) AS rk FROM parts n JOIN parts p ON n.part_id = p.part_id AND p.valid_from < n.valid_from)
SELECT part_id, valid_from::VARCHAR AS valid_from, prior_from::VARCHAR AS prior_from, flag_changed FROM j WHERE rk = 1""")
def prior_versions(r: Relations) -> DataFrame:
    """The version before each: one window instead of a theta join, so a key of many versions costs no square."""
    order = Window.partitionBy("part_id").orderBy("valid_from")
    rows = r.part_versions.select("part_id", "valid_from", "flag", F.lag("valid_from").over(order).alias("prior_from"), F.struct(F.lag("flag").over(order).alias("flag")).alias("p"))
    rows = rows.where("prior_from IS NOT NULL").select("part_id", "valid_from", "prior_from", F.struct("flag").alias("n"), "p")
    return rows.select("part_id", F.col("valid_from").cast("string").alias("valid_from"), F.col("prior_from").cast("string").alias("prior_from"), changed("n", "p", ["flag"]).alias("flag_changed"))


@query("allowlisted_columns", "P8 P13 P15", """SELECT s_suppkey, s_name, s_nationkey, ends_with(s_name, '7') AS audited FROM supplier""")
def allowlisted_columns(r: Relations) -> DataFrame:
    """What may leave the raw layer, by an explicit list of columns; a forbidden column raises."""
    allowed = quality.allowlisted(r.table("supplier"), ["s_suppkey", "s_name", "s_nationkey"], forbidden=["s_acctbal"])
    return allowed.withColumn("audited", F.endswith("s_name", F.lit("7")))


@query("largest_orders", "O1 O2", """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS total FROM orders ORDER BY total DESC, o_orderkey LIMIT 25""")
def largest_orders(r: Relations) -> DataFrame:
    return r.orders.select("o_orderkey", "total").orderBy(F.desc("total"), "o_orderkey").limit(25)


@query("environment_gate", "QG15 S8 S27", """SELECT * FROM (VALUES ('canary', 0::BIGINT, true), ('table:no_such_table', 1::BIGINT, false)) t("check", failures, passed)""")
def environment(r: Relations) -> DataFrame:
    return quality.environment_gate(r.spark, ["no_such_table"], r.folder("canary"))


@query("sales_window_replay", "PR15 PR14 INC11 O6", "SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right")
def sales_window_replay(r: Relations) -> DataFrame:
    """Merging the last week again into the state leaves it as it was."""
    days = r.user_snapshots.select("user_id", "day", "kind", "events")
    span = last_days(r, 8)
    state = latest(days, ["user_id"], "day")
    again = latest(pending_range(days, "day", span[0], span[-1]), ["user_id"], "day")
    return multiset_difference(upsert(state, again, ["user_id"]), state)


@query("watermark_catch_up", "SCD14 QG16 INC8 INC9 S17 S18", """SELECT entity, committed::VARCHAR AS committed, status, date_diff('day', committed, d)::INT AS behind FROM (SELECT max(CAST(ts AS DATE)) AS d FROM events), (SELECT 'caught_up' AS entity, (SELECT max(CAST(ts AS DATE)) FROM events) AS committed, 'COMMITTED' AS status UNION ALL SELECT 'waiting', (SELECT max(CAST(ts AS DATE)) - 1 FROM events), 'PENDING_VALIDATION')""")
def watermark_catch_up(r: Relations) -> DataFrame:
    """Two entities, one committed up to the last day and one awaiting validation, and how far each is behind."""
    before, last = last_days(r, 2)
    marks = Watermarks(VersionedTable(r.spark, r.folder("marks")), r.spark)
    for entity in ("caught_up", "waiting"):
        marks.seed(entity, before)
        marks.move(entity, COMMITTED, PENDING, before, last)
    marks.move("caught_up", PENDING, COMMITTED, last, None)
    return marks.table.read().select("entity", F.col("committed").cast("string").alias("committed"), "status", F.datediff(F.lit(last), "committed").alias("behind"))
