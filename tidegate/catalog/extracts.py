"""Extraction: one row per key, watermarks, filters, projections, contracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegate.catalog.registry import query, table
from tidegate.functions import decode, effective_change_time, format_watermark
from tidegate.operators import filters
from tidegate.operators.audit import Audited, load_audit, load_report
from tidegate.operators.contracts import REASONS, Contract, accepted, conform, key_report, non_null_keys
from tidegate.operators.dedupe import dedupe_latest, distinct_keys, union_distinct
from tidegate.operators.membership import (
    exclude_keys,
    filter_by_ids,
    filter_by_relation,
    include_keys,
)
from tidegate.operators.names import exclude_columns
from tidegate.plans.database import suffix_governed
from tidegate.plans.export import payroll_export, primary_aliases
from tidegate.sinks import ledger
from tidegate.sinks.tables import transform, write_table
from tidegate.sinks.targets import CHUNK, chunk_of
from tidegate.sources.tables import id_list, keyset
from tidegate.workspace import scratch_path

ORDERED = ", ".join(
    f"{c} DESC NULLS LAST"
    for c in "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus".split()
)


@query(
    "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
    "ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events) WHERE rn = 1"
)
def dedupe_latest_events(spark, sf_dir):
    return dedupe_latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@query(
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDERED}) "
    "AS rn FROM lineitem) WHERE rn = 1"
)
def dedupe_latest_lineitem(spark, sf_dir):
    return dedupe_latest(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "SELECT customer, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY customer ORDER BY "
    "o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL "
    "ELSE o_custkey END AS customer, o_orderkey, o_orderdate FROM orders)) WHERE rn = 1"
)
def dedupe_latest_null_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer")
    return dedupe_latest(orders.select(customer, "o_orderkey", "o_orderdate"), ["customer"], ["o_orderdate"])


@query("SELECT DISTINCT o_orderkey AS key FROM orders UNION SELECT DISTINCT l_orderkey FROM lineitem")
def union_distinct_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    return union_distinct(orders, lines, ["key"])


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL")
def distinct_key_pairs(spark, sf_dir):
    return distinct_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("SELECT DISTINCT l_suppkey AS supplier FROM lineitem WHERE l_suppkey IS NOT NULL")
def source_keyset(spark, sf_dir):
    return keyset(table(spark, sf_dir, "lineitem"), "l_suppkey").select(F.col("l_suppkey").cast("bigint").alias("supplier"))


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_extract(spark, sf_dir):
    return filters.after_watermark(table(spark, sf_dir, "events"), "ts", dt.datetime(2024, 1, 15))


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-14 22:00:00'")
def incremental_extract_lookback(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return filters.after_watermark(events, "ts", "2024-01-15 00:00:00", dt.timedelta(hours=2))


@query(
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS changed FROM events "
    "WHERE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') > '2024-01-15 12:00:00.000000'"
)
def incremental_extract_text(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", format_watermark("ts").alias("changed"))
    return filters.after_watermark(events, "changed", dt.datetime(2024, 1, 15, 12))


@query(
    "SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS high_water, "
    "strftime(max(ts), '%Y-%m-%d %H:%M:%S.%g') AS high_water_ms FROM events GROUP BY event_type"
)
def watermark_max(spark, sf_dir):
    latest = table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("ts"))
    return latest.select("event_type", format_watermark("ts").alias("high_water"), format_watermark("ts", 3).alias("high_water_ms"))


@query(
    "SELECT n.c_name AS table_name, coalesce(max(o_orderdate) FILTER (o_orderstatus = 'F'), TIMESTAMP '1900-01-01') "
    "AS last_load FROM customer n LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n.c_name"
)
def ledger_watermark(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    loads = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("TABLE_NAME"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("LOAD_COMPLETE_FLAG"),
        F.col("o_orderdate").alias("LAST_LOAD_TIMESTAMP"),
    )
    complete = ledger.complete_watermarks(loads)
    never = F.lit(ledger.EPOCH.isoformat(sep=" ")).cast("timestamp_ntz")
    return names.join(complete, F.col("c_custkey") == F.col("TABLE_NAME"), "left").select(
        F.col("c_name").alias("table_name"), F.coalesce("LAST_LOAD_TIMESTAMP", never).alias("last_load")
    )


def _nations(spark, sf_dir, region):
    """Nation keys of a region: a governance list."""
    regions = table(spark, sf_dir, "region").where(F.col("r_name") == region)
    nations = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return nations.select("n_nationkey")


ASIA = "(SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')"


@query(f"SELECT * FROM customer WHERE c_nationkey IN {ASIA}")
def filter_include_ids(spark, sf_dir):
    return filter_by_ids(table(spark, sf_dir, "customer"), "C_NATIONKEY", _nations(spark, sf_dir, "ASIA"), "include")


@query(f"SELECT * FROM customer WHERE c_nationkey NOT IN {ASIA}")
def filter_exclude_ids(spark, sf_dir):
    return filter_by_ids(table(spark, sf_dir, "customer"), "c_nationkey", _nations(spark, sf_dir, "ASIA"), "exclude")


@query(f"SELECT * FROM supplier WHERE s_nationkey IN {ASIA}")
def filter_by_list_file(spark, sf_dir):
    """Ids kept in a text file, one per line with a trailing comma."""
    path = scratch_path(spark, "ids")
    listed = F.concat(F.lit(" "), F.col("n_nationkey").cast("string"), F.lit(","))
    _nations(spark, sf_dir, "ASIA").select(listed).write.text(path)
    ids = id_list(spark, path, required=True)
    return filter_by_relation(table(spark, sf_dir, "supplier"), "s_nationkey", ids, "id", "include")


BUILDERS = "(SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')"


def _many_customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING").select("c_custkey")


@query(f"SELECT * FROM orders WHERE o_custkey IN {BUILDERS}")
def filter_include_many_ids(spark, sf_dir):
    """A list of more ids than one predicate may hold stays a frame."""
    return filter_by_ids(table(spark, sf_dir, "orders"), "o_custkey", _many_customers(spark, sf_dir), "include")


@query(f"SELECT * FROM orders WHERE o_custkey NOT IN {BUILDERS}")
def filter_exclude_many_ids(spark, sf_dir):
    return filter_by_ids(table(spark, sf_dir, "orders"), "o_custkey", _many_customers(spark, sf_dir), "exclude")


@query(f"SELECT * FROM supplier WHERE s_nationkey IN {ASIA}")
def id_list_json(spark, sf_dir):
    """Ids kept as an array in a JSON file."""
    path = f"{scratch_path(spark, 'ids')}.json"
    nations = _nations(spark, sf_dir, "ASIA").agg(F.collect_list("n_nationkey").alias("route_ids"))
    nations.coalesce(1).write.json(path)
    return filter_by_relation(table(spark, sf_dir, "supplier"), "s_nationkey", id_list(spark, path, required=True), "id")


@query("SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'O''BRIEN', ' MACHINERY')")
def filter_include_codes(spark, sf_dir):
    return filter_by_ids(table(spark, sf_dir, "customer"), "c_mktsegment", ["BUILDING", "O'BRIEN", " MACHINERY"])


@query(
    "WITH k AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer FROM orders), "
    "x AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') "
    "SELECT 'not_in' AS mode, o_orderkey, customer FROM k WHERE customer NOT IN (SELECT c_custkey FROM x) "
    "UNION ALL SELECT 'anti', o_orderkey, customer FROM k WHERE NOT EXISTS (SELECT 1 FROM x WHERE c_custkey = customer)"
)
def exclude_null_semantics(spark, sf_dir):
    customer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", customer)
    excluded = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    excluded = excluded.select(F.col("c_custkey").alias("customer"))
    not_in = exclude_keys(orders, excluded, ["customer"], drop_nulls=True).withColumn("mode", F.lit("not_in"))
    return not_in.unionByName(exclude_keys(orders, excluded, ["customer"]).withColumn("mode", F.lit("anti")))


@query("SELECT * FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
def filter_include_relation(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return filter_by_relation(table(spark, sf_dir, "lineitem"), "L_ORDERKEY", finished, "O_ORDERKEY", "include")


@query("SELECT * FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
def filter_exclude_relation(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    return filter_by_relation(table(spark, sf_dir, "lineitem"), "l_orderkey", finished, "o_orderkey", "exclude")


@query(
    "SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))"
)
def nested_membership(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    customers = customers.select(F.col("c_custkey").alias("o_custkey"))
    orders = include_keys(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), customers, ["o_custkey"])
    return filter_by_relation(table(spark, sf_dir, "lineitem"), "l_orderkey", orders, "o_orderkey")


@query(
    "SELECT * FROM (SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END "
    "AS is_deleted FROM orders) WHERE is_deleted = false OR is_deleted IS NULL"
)
def soft_delete_active(spark, sf_dir):
    flag = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).alias("is_deleted")
    return filters.not_soft_deleted(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", flag))


@query("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 48 MONTH")
def history_window(spark, sf_dir):
    return filters.history_window(table(spark, sf_dir, "orders"), "o_orderdate", dt.date(2001, 8, 1))


@query("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'")
def bounded_backfill(spark, sf_dir):
    return filters.between_bounds(table(spark, sf_dir, "orders"), "o_orderdate", "1997-01-01", "1998-01-01")


@query(
    f"SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey IN {ASIA} AND c_mktsegment NOT LIKE '%-D' "
    "THEN c_mktsegment || '-D' ELSE c_mktsegment END AS c_mktsegment FROM customer"
)
def governed_suffix(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    governed = _nations(spark, sf_dir, "ASIA")
    once = suffix_governed(customers, ("c_nationkey", "c_mktsegment"), governed)
    return suffix_governed(once, ("c_nationkey", "c_mktsegment"), governed)


def _aliases(spark, sf_dir):
    segment = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("FACILITY_ALIAS_ID"),
        F.col("c_custkey").alias("FACILITY_ID"),
        F.when(segment == "BUILDING", 0).when(segment != "FURNITURE", 1).alias("IS_PRIMARY"),
        F.when(segment == "MACHINERY", 1).when(segment != "AUTOMOBILE", 0).alias("MARK_FOR_DELETION"),
    )


ALIASES = (
    "SELECT c_name AS FACILITY_ALIAS_ID, c_custkey AS FACILITY_ID FROM customer "
    "WHERE c_mktsegment IN ('HOUSEHOLD', 'AUTOMOBILE')"
)


@query(f"SELECT FACILITY_ALIAS_ID AS alias, FACILITY_ID AS facility FROM ({ALIASES})")
def primary_alias_lookup(spark, sf_dir):
    kept = primary_aliases(_aliases(spark, sf_dir))
    return kept.select(F.col("FACILITY_ALIAS_ID").alias("alias"), F.col("FACILITY_ID").cast("bigint").alias("facility"))


@query(
    f"WITH a AS ({ALIASES}) SELECT FACILITY_ALIAS_ID AS DispatchAlias, CAST(o_orderdate AS DATE) AS WeekEndDate, "
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'SentToCAPs' WHEN '2-HIGH' THEN 'Fail' WHEN '3-MEDIUM' THEN 'Preparing' "
    "WHEN '4-NOT SPECIFIED' THEN 'SentForPayroll' ELSE '999' END AS Status, CAST(year(o_orderdate) AS INT) AS DriverCount, "
    "CAST(month(o_orderdate) AS INT) AS TripCount, CAST(o_totalprice AS DECIMAL(9,2)) AS TotalPayMinutes, "
    "CAST(o_totalprice AS DECIMAL(9,2)) AS TopDriverMinutes, o_orderdate AS CreatedDateTime, "
    "CASE WHEN o_orderstatus = 'P' THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END AS UpdatedDateTime, "
    "o_orderpriority AS UpdatedUserID FROM orders LEFT JOIN a ON o_custkey = FACILITY_ID"
)
def payroll_export_rows(spark, sf_dir):
    priority = F.col("o_orderpriority")
    code = F.when(priority == "1-URGENT", 100).when(priority == "2-HIGH", 300).when(priority == "3-MEDIUM", 400)
    code = code.when(priority == "4-NOT SPECIFIED", 700).otherwise(999)
    caps = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("DS_FAC_ID"),
        F.col("o_orderdate").cast("date").alias("CE_WK_ENDDT"),
        code.cast("decimal(38,0)").alias("CEST_CD"),
        F.year("o_orderdate").cast("decimal(38,0)").alias("CE_DRIVER_CNT"),
        F.month("o_orderdate").cast("decimal(38,0)").alias("CE_TRIP_CNT"),
        F.col("o_totalprice").cast("decimal(9,2)").alias("CE_TOT_PAY_MINS"),
        F.col("o_totalprice").cast("decimal(9,2)").alias("CE_TOP_DRIVER_MINS"),
        F.col("o_orderdate").alias("CREATE_TS"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("LAST_UPD_TS"),
        priority.alias("LAST_UPD_USERID"),
    )
    return payroll_export(caps, _aliases(spark, sf_dir))


@query(
    "SELECT o_orderkey, CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'first' WHEN substr(o_orderpriority, 1, 1) = '2' "
    "THEN 'second' ELSE substr(o_orderpriority, 1, 1) END AS rank, o_orderpriority AS label FROM orders"
)
def code_decode(spark, sf_dir):
    names = {1: "first", 2: "second"}
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", decode(F.substring(priority, 1, 1), names).alias("rank"), decode(priority, names).alias("label")
    )


@query(
    "SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_returnflag = 'R' THEN l_shipdate END, o_orderdate) AS changed "
    "FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey"
)
def effective_change(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("updated")
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = lines.join(orders, "l_orderkey", "left")
    return joined.select("l_orderkey", "l_linenumber", effective_change_time("updated", "o_orderdate").alias("changed"))


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def stage_preview(spark, sf_dir):
    """The default preview of a completed stage, here of the largest orders."""
    ranked = table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return filters.preview(ranked, "", when_unset=100)


@query("SELECT * EXCLUDE (l_tax, l_discount) FROM lineitem")
def column_exclusion(spark, sf_dir):
    return exclude_columns(table(spark, sf_dir, "lineitem"), ["L_TAX", "l_Discount"])


@query("SELECT o_orderstatus, count(*) AS orders, max(o_orderdate) AS latest FROM orders GROUP BY o_orderstatus")
def transform_sql(spark, sf_dir):
    text = "SELECT o_orderstatus, count(*) AS orders, max(o_orderdate) AS latest FROM order_stage GROUP BY o_orderstatus"
    return transform(table(spark, sf_dir, "orders"), text, "order_stage")


ORDER_COLUMNS = [
    ("OrderId", "INT", False),
    ("Status", "NVARCHAR(1)", False),
    ("Priority", "NVARCHAR(8)", False),
    ("Total", "DECIMAL(7,2)", False),
    ("OrderDate", "DATE", True),
    ("Level", "INT", True),
]


def _order_contract() -> Contract:
    return Contract.from_sql_server("Order", ORDER_COLUMNS, keys=["OrderId"])


# The same rows in the oracle; a total of 99999.995 or more does not fit DECIMAL(7,2).
SHAPED = (
    "SELECT o_orderkey AS id, nullif(o_orderstatus, 'P') AS st, o_orderpriority AS pr, CAST(o_totalprice AS DECIMAL(15,2)) "
    "AS total, CAST(o_orderdate AS DATE) AS od, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE "
    "substr(o_orderpriority, 1, 1) END AS lv FROM orders"
)


def _shaped_orders(spark, sf_dir):
    level = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(F.substring("o_orderpriority", 1, 1))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderid"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("total"),
        F.col("o_orderdate").alias("orderdate"),
        level.alias("level"),
    )


@query(
    f"SELECT CAST(id AS INT) AS OrderId, st AS Status, pr AS Priority, CAST(total AS DECIMAL(7,2)) AS Total, od AS OrderDate, "
    f"CAST(lv AS INT) AS Level FROM ({SHAPED}) WHERE st = 'O' AND length(pr) <= 8 AND total < 100000"
)
def conform_accept(spark, sf_dir):
    return accepted(conform(_shaped_orders(spark, sf_dir), _order_contract()))


@query(
    "SELECT id AS order_id, concat_ws('; ', CASE WHEN st IS NULL THEN 'Status: missing' END, CASE WHEN length(pr) > 8 THEN "
    "'Priority: too long' END, CASE WHEN total >= 100000 THEN 'Total: not a decimal(7,2)' END, CASE WHEN st = 'F' THEN "
    f"'Level: not a int' END) AS reasons FROM ({SHAPED}) WHERE st IS DISTINCT FROM 'O' OR length(pr) > 8 OR total >= 100000"
)
def conform_reject(spark, sf_dir):
    broken = conform(_shaped_orders(spark, sf_dir), _order_contract()).where(F.size(REASONS) > 0)
    order_id = F.get_json_object("__row", "$.orderid").cast("bigint")
    return broken.select(order_id.alias("order_id"), F.array_join(REASONS, "; ").alias("reasons"))


@query(
    "SELECT count(*) AS row_count, count(DISTINCT l_orderkey) AS key_count, CAST(0 AS BIGINT) AS split_keys FROM lineitem"
)
def chunk_partition(spark, sf_dir):
    placed = chunk_of(table(spark, sf_dir, "lineitem"), "L_ORDERKEY", 16)
    per_key = placed.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min(CHUNK).alias("low"), F.max(CHUNK).alias("high")
    )
    return per_key.agg(
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("low") != F.col("high")).alias("split_keys"),
    )


KEY_REPORT = (
    "SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count, count(*) FILTER (n > 1) AS duplicate_key_count "
    "FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"
)


@query(KEY_REPORT.format(table="lineitem", keys="l_orderkey, l_linenumber"))
def key_uniqueness(spark, sf_dir):
    return key_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "SELECT count(*) AS row_count, count(DISTINCT customer) AS key_count FROM "
    "(SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer FROM orders)"
)
def distinct_key_count(spark, sf_dir):
    """Rows and distinct non-NULL keys."""
    customer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer")
    return non_null_keys(table(spark, sf_dir, "orders").select(customer), ["customer"])


@query("SELECT o_orderkey AS \"OrderId\", o_orderstatus AS \"Status\" FROM orders")
def column_contract(spark, sf_dir):
    """Rows whose columns have been checked against a contract; other columns are refused."""
    contract = Contract.from_sql_server("Order", ORDER_COLUMNS[:2], keys=["OrderId"])
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("OrderId"), F.col("o_orderstatus").alias("Status"))
    contract.check_columns(orders)
    return orders


@query(
    "SELECT 'customer' AS entity_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders"
)
def load_report_counts(spark, sf_dir):
    """Report of a stage whose counts were taken while it was written."""
    counts = {}
    for name in ("orders", "customer"):
        counts[name] = write_table(table(spark, sf_dir, name), scratch_path(spark, name), "overwrite")["rows"]
    return load_report(spark, counts)


def _audit_sql(name: str, keys: str, stamp: str) -> str:
    return (
        f"SELECT '{name}' AS entity_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count, count(*) FILTER (n > 1) "
        f"AS duplicate_key_count, strftime(max(seen), '%Y-%m-%d %H:%M:%S.%f') AS max_watermark FROM "
        f"(SELECT count(*) AS n, {stamp} AS seen FROM {name} GROUP BY {keys})"
    )


NO_STAMP = "CAST(NULL AS TIMESTAMP)"


@query(
    " UNION ALL ".join(
        [
            _audit_sql("conversations", "conv_id, turn", NO_STAMP),
            _audit_sql("customer", "c_custkey", NO_STAMP),
            _audit_sql("documents", "doc_id", NO_STAMP),
            _audit_sql("events", "event_id", "max(ts)"),
            _audit_sql("lineitem", "l_orderkey, l_linenumber", "max(l_shipdate)"),
            _audit_sql("orders", "o_orderkey", "max(o_orderdate)"),
        ]
    )
)
def load_audit_report(spark, sf_dir):
    return load_audit(
        {
            "orders": Audited(table(spark, sf_dir, "orders"), ["o_orderkey"], "o_orderdate"),
            "lineitem": Audited(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"),
            "events": Audited(table(spark, sf_dir, "events"), ["event_id"], "ts"),
            "customer": Audited(table(spark, sf_dir, "customer"), ["c_custkey"]),
            "documents": Audited(table(spark, sf_dir, "documents"), ["doc_id"]),
            "conversations": Audited(table(spark, sf_dir, "conversations"), ["conv_id", "turn"]),
        }
    )
