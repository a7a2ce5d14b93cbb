"""Merges, replicas and clustering."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidegate.catalog.registry import query, table
from tidegate.operators import merge
from tidegate.operators.deletes import merge_snapshot
from tidegate.sinks import tables
from tidegate.workspace import scratch_path

BASE = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
CHANGED = "SELECT * REPLACE ('X' AS o_orderstatus) FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'"


def _base(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < "1999-01-01")


def _changed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= "1997-01-01")
    return orders.withColumn("o_orderstatus", F.lit("X"))


UPSERTED = (
    f"WITH b AS ({BASE}), u AS ({CHANGED}) SELECT * FROM b WHERE NOT EXISTS "
    "(SELECT 1 FROM u WHERE u.o_orderkey = b.o_orderkey) UNION ALL SELECT * FROM u"
)


@query(UPSERTED)
def upsert_orders(spark, sf_dir):
    return merge.upsert(_base(spark, sf_dir), _changed(spark, sf_dir), ["o_orderkey"])


@query(UPSERTED)
def upsert_bucketed_table(spark, sf_dir):
    path = scratch_path(spark, "orders")
    tables.write_bucketed(_base(spark, sf_dir), path, ["o_orderkey"])
    for _ in range(2):
        tables.merge_into(spark, path, _changed(spark, sf_dir), ["o_orderkey"])
    return tables.read_bucketed(spark, path)


NULLED = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END"


@query(
    f"WITH b AS (SELECT {NULLED} AS k, o_orderstatus, o_totalprice FROM ({BASE})), "
    f"u AS (SELECT {NULLED} AS k, o_orderstatus, o_totalprice FROM ({CHANGED})) "
    "SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.k = b.k) UNION ALL SELECT * FROM u"
)
def upsert_null_keys(spark, sf_dir):
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("k")
    columns = [key, "o_orderstatus", "o_totalprice"]
    return merge.upsert(_base(spark, sf_dir).select(*columns), _changed(spark, sf_dir).select(*columns), ["k"])


@query(
    "WITH b AS (SELECT l_orderkey AS k, l_returnflag AS flag, l_shipdate AS seen FROM lineitem), "
    "u AS (SELECT o_orderkey AS k, 'U' AS flag, o_orderdate AS seen FROM orders WHERE o_orderstatus = 'F') "
    "SELECT b.k, coalesce(u.flag, b.flag) AS flag, CASE WHEN u.k IS NULL THEN b.seen ELSE u.seen END AS seen "
    "FROM b LEFT JOIN u ON b.k = u.k UNION ALL SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = u.k)"
)
def upsert_repeated_base(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("flag"), F.col("l_shipdate").alias("seen")
    )
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    updates = orders.select(F.col("o_orderkey").alias("k"), F.lit("U").alias("flag"), F.col("o_orderdate").alias("seen"))
    return merge.upsert(lines, updates, ["k"], base_is_unique=False)


@query(
    "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"
)
def incremental_equals_full(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    early, late = F.col("ts") < "2024-01-11", F.col("ts") >= "2024-01-21"
    parts = [events.where(test) for test in (early, ~early & ~late, late)]
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    state = merge.merge_latest(parts[1].limit(0), parts[1], keys, order)
    for part in (parts[0], parts[2], parts[1]):
        state = merge.merge_latest(state, part, keys, order)
    return state


@query(
    f"WITH b AS ({BASE}), u AS ({CHANGED}) SELECT * FROM b UNION ALL SELECT * FROM u WHERE NOT EXISTS "
    "(SELECT 1 FROM b WHERE b.o_orderkey = u.o_orderkey)"
)
def insert_if_absent(spark, sf_dir):
    return merge.insert_absent(_base(spark, sf_dir), _changed(spark, sf_dir), ["o_orderkey"])


RANKED = ", ".join(
    f"{c} DESC NULLS LAST"
    for c in "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()
)


@query(
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {RANKED}) AS rn "
    "FROM lineitem) l WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM lineitem h WHERE h.l_returnflag = 'R' "
    "AND h.l_orderkey = l.l_orderkey AND h.l_linenumber = l.l_linenumber)"
)
def append_dedupe_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    held = lines.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber")
    return merge.absent_rows(held, lines, ["l_orderkey", "l_linenumber"])


@query(
    f"WITH s AS (SELECT o_orderkey AS k, o_orderdate AS t FROM ({BASE})), n AS (SELECT o_orderkey AS k FROM ({CHANGED})) "
    "SELECT coalesce(s.k, n.k) AS order_key, CASE WHEN n.k IS NOT NULL THEN TIMESTAMP '2002-01-01 08:00:00' ELSE t END "
    'AS "Snapshot_Timestamp" FROM s FULL JOIN n ON s.k = n.k'
)
def snapshot_merge(spark, sf_dir):
    key = F.col("o_orderkey").alias("order_key")
    held = _base(spark, sf_dir).select(key, F.col("o_orderdate").alias("Snapshot_Timestamp"))
    return merge_snapshot(held, _changed(spark, sf_dir).select(key), "order_key", dt.datetime(2002, 1, 1, 8))


@query(
    f"WITH b AS ({BASE}), u AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM ({CHANGED})) "
    "SELECT coalesce(b.o_orderkey, u.o_orderkey) AS o_orderkey, coalesce(b.o_custkey, u.o_custkey) AS o_custkey, "
    "coalesce(u.o_orderstatus, b.o_orderstatus) AS o_orderstatus, coalesce(b.o_totalprice, u.o_totalprice) AS o_totalprice, "
    "coalesce(b.o_orderdate, u.o_orderdate) AS o_orderdate, coalesce(b.o_orderpriority, u.o_orderpriority) AS o_orderpriority "
    "FROM b FULL JOIN u ON b.o_orderkey = u.o_orderkey"
)
def update_listed_columns(spark, sf_dir):
    changed = _changed(spark, sf_dir).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return merge.update_columns(_base(spark, sf_dir), changed, ["o_orderkey"], ["O_ORDERSTATUS"])


@query("SELECT *, true AS same FROM customer")
def replica_refresh(spark, sf_dir):
    primary, copy = scratch_path(spark, "customer"), scratch_path(spark, "customer-replica")
    tables.write_bucketed(table(spark, sf_dir, "customer"), primary, ["c_custkey"])
    tables.replicate(spark, primary, copy)
    replica = tables.read_bucketed(spark, copy)
    same = tables.same_content(tables.read_bucketed(spark, primary), replica)
    return replica.withColumn("same", F.lit(same))


@query("SELECT * FROM lineitem")
def compacted_table(spark, sf_dir):
    path = scratch_path(spark, "lineitem")
    tables.write_table(table(spark, sf_dir, "lineitem"), path, "overwrite")
    tables.compact(spark, path, ["l_orderkey"], file_bytes=1 << 20)
    return spark.read.parquet(path)


@query(
    "SELECT count(*) AS row_count, count(DISTINCT o_orderkey) AS key_count, CAST(0 AS BIGINT) AS misplaced FROM orders"
)
def bucketed_layout(spark, sf_dir):
    path = scratch_path(spark, "orders-bucketed")
    tables.write_bucketed(table(spark, sf_dir, "orders"), path, ["o_orderkey"], 16)
    stored = spark.read.parquet(path)
    per_key = stored.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.first(tables.BUCKET).alias("held"))
    placed = F.col("held") == tables.key_bucket(["o_orderkey"], 16)
    return per_key.agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("key_count"), F.count_if(~placed).alias("misplaced")
    )
