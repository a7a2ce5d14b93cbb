"""Delete detection over orders: the source still has the orders with an open line."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegate.catalog.registry import query, table
from tidegate.operators import deletes
from tidegate.plans.reconcile import DeleteTables, active_view, detect, optimize
from tidegate.sinks import tables
from tidegate.workspace import scratch_path

KEY = "order_key"
AS_OF = dt.datetime(2002, 1, 1, 22, 30)

SOURCE = "SELECT DISTINCT l_orderkey AS order_key FROM lineitem WHERE l_linestatus = 'O'"
ACTIVE = "SELECT DISTINCT o_orderkey AS order_key FROM orders WHERE o_orderstatus <> 'F'"
HISTORY = "SELECT DISTINCT l_orderkey AS order_key FROM lineitem"
MISSING = f"SELECT order_key FROM ({ACTIVE}) EXCEPT SELECT order_key FROM ({SOURCE})"
MISSING_FULL = (
    f"(SELECT order_key FROM ({ACTIVE}) UNION SELECT order_key FROM ({HISTORY})) EXCEPT SELECT order_key FROM ({SOURCE})"
)
# Events that exist already: urgent orders, detected on their order date and again a day later.
EVENTS = (
    "SELECT o_orderkey AS order_key, o_orderdate AS seen FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL "
    "SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderpriority = '1-URGENT'"
)


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", KEY)


def _source(spark, sf_dir):
    return deletes.source_keys(_lines(spark, sf_dir).where(F.col("l_linestatus") == "O"), KEY)


def _current(spark, sf_dir):
    deleted = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    return table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", KEY).withColumn("IS_DELETED", deleted)


def _events(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    first = urgent.select(F.col("o_orderkey").alias(KEY), F.col("o_orderdate").cast("timestamp").alias(deletes.DETECTED_TS))
    again = first.withColumn(deletes.DETECTED_TS, F.col(deletes.DETECTED_TS) + F.expr("INTERVAL 1 DAY"))
    return deletes.bucketed_layout(first.unionByName(again), KEY, AS_OF)


def _shown(events):
    """Events without the bucket, with the detection time free of a zone."""
    return events.select(
        KEY, F.col(deletes.DETECTED_TS).cast("timestamp_ntz").alias("detected_at"), F.col(deletes.DETECTED_DATE).alias("detected_date")
    )


@query(ACTIVE)
def delete_active_keys(spark, sf_dir):
    return deletes.active_keys(_current(spark, sf_dir), KEY)


@query(MISSING)
def delete_candidates_incremental(spark, sf_dir):
    return deletes.missing_keys(deletes.held_keys(_current(spark, sf_dir), KEY), _source(spark, sf_dir), KEY)


@query(f"SELECT order_key, false AS equal_differ FROM ({MISSING})")
def reconcile_by_digest(spark, sf_dir):
    """Candidates from the buckets of keys whose digests differ; equal sides have no such bucket."""
    held, source = deletes.held_keys(_current(spark, sf_dir), KEY), _source(spark, sf_dir)
    equal = deletes.differing_buckets(source, source.repartition(7), KEY).isEmpty()
    return deletes.missing_by_digest(held, source, KEY).withColumn("equal_differ", F.lit(not equal))


@query(MISSING_FULL)
def delete_candidates_full(spark, sf_dir):
    held = deletes.held_keys(_current(spark, sf_dir), KEY)
    return deletes.missing_keys_full(held, _lines(spark, sf_dir), _source(spark, sf_dir), KEY)


@query(
    f"SELECT order_key, TIMESTAMP '2002-01-01 22:30:00' AS detected_at, DATE '2002-01-01' AS detected_date FROM "
    f"(({MISSING_FULL}) EXCEPT SELECT order_key FROM ({EVENTS}))"
)
def delete_events_new(spark, sf_dir):
    candidates = delete_candidates_full(spark, sf_dir)
    return _shown(deletes.new_events(candidates, _events(spark, sf_dir), KEY, AS_OF))


@query(f"SELECT order_key, max(seen) AS detected_at, CAST(max(seen) AS DATE) AS detected_date FROM ({EVENTS}) GROUP BY order_key")
def delete_events_sync(spark, sf_dir):
    return _shown(deletes.latest_events(_events(spark, sf_dir), KEY))


@query(f"SELECT o_orderkey AS order_key, o_custkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT order_key FROM ({EVENTS}))")
def active_rows(spark, sf_dir):
    return deletes.active_rows(_current(spark, sf_dir), _events(spark, sf_dir), KEY).select(KEY, "o_custkey", "o_orderdate")


@query(
    f"SELECT order_key, seen AS detected_at, CAST(seen AS DATE) AS detected_date FROM ({EVENTS}) "
    f"WHERE order_key NOT IN (SELECT order_key FROM ({SOURCE}))"
)
def delete_retract(spark, sf_dir):
    return _shown(deletes.retract_events(_events(spark, sf_dir), _source(spark, sf_dir), KEY))


@query(
    "SELECT order_key, coalesce(seen, TIMESTAMP '2002-01-01 22:30:00') AS detected_at, "
    "CAST(coalesce(seen, TIMESTAMP '2002-01-01 22:30:00') AS DATE) AS detected_date FROM (SELECT CASE WHEN o_orderstatus = 'F' "
    "THEN NULL ELSE o_orderkey END AS order_key, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS seen FROM orders) "
    "WHERE order_key IS NOT NULL"
)
def event_layout_migration(spark, sf_dir):
    path = scratch_path(spark, "events")
    status = F.col("o_orderstatus")
    old = table(spark, sf_dir, "orders").select(
        F.when(status != "F", F.col("o_orderkey")).alias(KEY),
        F.when(status != "O", F.col("o_orderdate")).cast("timestamp").alias(deletes.DETECTED_TS),
    )
    tables.write_table(old, path, "overwrite")
    tables.migrate_events(spark, path, KEY, AS_OF)
    tables.migrate_events(spark, path, KEY, AS_OF)
    return _shown(spark.read.parquet(path))


@query(
    f"WITH first AS (SELECT order_key FROM ({ACTIVE}) EXCEPT SELECT l_orderkey FROM lineitem), "
    f"second AS (({MISSING_FULL}) EXCEPT SELECT order_key FROM first) "
    "SELECT order_key, TIMESTAMP '2001-12-31 22:30:00' AS detected_at, DATE '2001-12-31' AS detected_date FROM first "
    "UNION ALL SELECT order_key, TIMESTAMP '2002-01-01 22:30:00', DATE '2002-01-01' FROM second"
)
def delete_detection_runs(spark, sf_dir):
    """An incremental run while every line is still there, then a full run on open lines only, twice."""
    folder = scratch_path(spark, "deletes")
    state = DeleteTables(f"{folder}/snapshot", f"{folder}/events", f"{folder}/current", KEY)
    current, lines = _current(spark, sf_dir), _lines(spark, sf_dir)
    detect(spark, state, lines, current, AS_OF - dt.timedelta(days=1))
    for _ in range(2):
        detect(spark, state, _source(spark, sf_dir), current, AS_OF, "full", lines)
    return _shown(spark.read.parquet(state.current_events))


@query(
    f"SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_orderkey NOT IN ({MISSING}) GROUP BY o_orderstatus"
)
def active_view_sql(spark, sf_dir):
    """SQL over the view of active rows after one incremental run."""
    folder = scratch_path(spark, "deletes")
    state = DeleteTables(f"{folder}/snapshot", f"{folder}/events", f"{folder}/current", KEY)
    current = _current(spark, sf_dir)
    detect(spark, state, _source(spark, sf_dir), current, AS_OF)
    active_view(spark, "active_orders", current, state)
    return spark.sql("SELECT o_orderstatus, count(*) AS orders FROM active_orders GROUP BY o_orderstatus")


@query(
    f"SELECT order_key, TIMESTAMP '2002-01-01 22:30:00' AS detected_at, DATE '2002-01-01' AS detected_date FROM ({MISSING})"
)
def events_clustered(spark, sf_dir):
    """Events of one incremental run after their tables have been clustered by key."""
    folder = scratch_path(spark, "deletes")
    state = DeleteTables(f"{folder}/snapshot", f"{folder}/events", f"{folder}/current", KEY)
    detect(spark, state, _source(spark, sf_dir), _current(spark, sf_dir), AS_OF)
    optimize(spark, state, file_bytes=1 << 14)
    return _shown(spark.read.parquet(state.events))
