"""Whole loads, run against tables in the shared folder."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from tidegate.catalog.registry import query, table
from tidegate.plans import database, lake
from tidegate.plans.specs import DatabaseEntity, LakeEntity
from tidegate.sinks import ledger
from tidegate.sinks.tables import (
    grow_buckets,
    held_buckets,
    merge_into,
    put_batch,
    read_bucketed,
    same_content,
    sync_batches,
    table_bytes,
    write_bucketed,
)
from tidegate.sinks.targets import FolderTarget
from tidegate.streaming.loads import dedupe_within, stream_upsert
from tidegate.workspace import scratch_path

AS_OF = dt.datetime(2024, 2, 1)
LATEST = (
    "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
    "ORDER BY ts DESC, event_id DESC) AS rn FROM {events}) WHERE rn = 1"
)


def _entity(folder: str, **changes) -> LakeEntity:
    settings = dict(
        name="Event",
        keys=["user_id", "event_type"],
        order=["ts", "event_id"],
        raw_path=f"{folder}/raw",
        current_path=f"{folder}/current",
        watermark="ts",
        incremental=True,
        buckets=16,
    )
    return LakeEntity(**settings | changes)


def _until(events, time):
    """The events a growing source holds before ``time``; in the end all of them."""
    return events if time is None else events.where(F.col("ts") < time)


@query(LATEST.format(keys="user_id, event_type", events="events"))
def incremental_load(spark, sf_dir):
    """Three hourly runs over a growing source; raw grows by append, the current state by merge."""
    folder, events = scratch_path(spark, "load"), table(spark, sf_dir, "events")
    entity = _entity(folder)
    for until in ("2024-01-10", "2024-01-20", None):
        lake.load(spark, entity, _until(events, until), "transactional", f"{folder}/ledger", AS_OF)
    return lake.current_state(spark, entity)


@query(
    "SELECT event_id, ts, user_id, event_type, value, props, true AS watermark_kept FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"
)
def incremental_load_raw_merge(spark, sf_dir):
    """The same with a merged and replicated raw table; shows the replica and checks the ledger."""
    folder, events = scratch_path(spark, "load"), table(spark, sf_dir, "events")
    entity = _entity(folder, raw_merge=True, raw_replica=f"{folder}/raw2", current_replica=f"{folder}/current2")
    for until in ("2024-01-15", None):
        lake.load(spark, entity, _until(events, until), "transactional", f"{folder}/ledger", AS_OF)
    seen = ledger.last_watermark(spark, f"{folder}/ledger", "Event")
    kept = seen == ledger.max_watermark(events, "ts")
    return read_bucketed(spark, entity.raw_replica).withColumn("watermark_kept", F.lit(kept))


def _batch_sql(test: str) -> str:
    batch = f"(SELECT * FROM events WHERE ts {test} TIMESTAMP '2024-01-15')"
    return LATEST.format(keys="user_id", events=batch)


@query(f"{_batch_sql('<')} UNION ALL {_batch_sql('>=')}")
def daily_append_load(spark, sf_dir):
    """Daily increments that are appended, each deduped by itself."""
    folder, events = scratch_path(spark, "append"), table(spark, sf_dir, "events")
    entity = _entity(folder, keys=["user_id"], grain="DAILY", append_daily=True)
    for until in ("2024-01-15", None):
        lake.load(spark, entity, _until(events, until), "transactional", f"{folder}/ledger", AS_OF)
    return lake.current_state(spark, entity)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def replica_append(spark, sf_dir):
    """Appended raw history whose replica gets only what each load appends."""
    folder, events = scratch_path(spark, "load"), table(spark, sf_dir, "events")
    entity = _entity(folder, keys=["event_id"], raw_replica=f"{folder}/raw2")
    for until in ("2024-01-15", None):
        lake.load(spark, entity, _until(events, until), "transactional", f"{folder}/ledger", AS_OF)
    return read_bucketed(spark, entity.raw_replica)


@query("SELECT event_id, ts, user_id, event_type, value, props, true AS replica_equal, 3 AS loads FROM events")
def replayed_append(spark, sf_dir):
    """Appended raw history in which runs have died before: what they left, half a batch in raw and in the replica, is
    replaced when the load is run again from the same watermark."""
    folder, events = scratch_path(spark, "load"), table(spark, sf_dir, "events")
    entity = _entity(folder, keys=["event_id"], raw_replica=f"{folder}/raw2")
    for until, copied in (("2024-01-10", False), ("2024-01-20", True), (None, False)):
        start = ledger.last_watermark(spark, f"{folder}/ledger", "Event")
        left = _until(events, until).where((F.col("ts") > F.lit(start)) & (F.col("event_id") % 2 == 0))
        put_batch(spark, left, entity.raw_path, start)
        if copied:
            sync_batches(spark, entity.raw_path, entity.raw_replica)
        lake.load(spark, entity, _until(events, until), "transactional", f"{folder}/ledger", AS_OF)
    raw, replica = (read_bucketed(spark, path) for path in (entity.raw_path, entity.raw_replica))
    loads = ledger.head_of(spark, f"{folder}/ledger", "Event").loads
    return raw.withColumns({"replica_equal": F.lit(same_content(raw, replica)), "loads": F.lit(loads)})


@query("SELECT event_id, ts, user_id, event_type, value, props, true AS split FROM events")
def bucket_growth(spark, sf_dir):
    """A table that five merges grow to 16 times its size: its buckets are split as it grows."""
    path, events = scratch_path(spark, "growing"), table(spark, sf_dir, "events")
    part = F.pmod(F.xxhash64("event_id"), F.lit(16))
    write_bucketed(events.where(part == 0), path, ["event_id"], 4)
    size = table_bytes(spark, path) // 4
    for low, high in ((1, 2), (2, 4), (4, 8), (8, 16)):
        merge_into(spark, path, events.where((part >= low - 1) & (part < high)), ["event_id"])
        grow_buckets(spark, path, ["event_id"], 2 * size)
    return read_bucketed(spark, path).withColumn("split", F.lit(held_buckets(spark, path) >= 16))


@query(
    "SELECT 'Event' AS name, max(ts) AS last_load, 20 AS loads, CAST(1 AS BIGINT) AS files FROM events UNION ALL "
    "SELECT 'Order', max(o_orderdate), 20, CAST(1 AS BIGINT) FROM orders"
)
def ledger_folded(spark, sf_dir):
    """Twenty loads of two names: what their heads say, and the files of the log after it has been folded."""
    path = scratch_path(spark, "ledger")
    latest = {"Event": ("events", "ts"), "Order": ("orders", "o_orderdate")}
    for name, (source, column) in latest.items():
        last = ledger.max_watermark(table(spark, sf_dir, source), column)
        for back in reversed(range(20)):
            ledger.append(spark, path, name, 1, last - dt.timedelta(hours=back), AS_OF)
    ledger.fold(spark, path)
    log = ledger.read(spark, path)
    files = len(log.inputFiles())
    heads = [ledger.head_of(spark, path, name) for name in latest]
    found = ledger.complete_watermarks(log).withColumnRenamed("TABLE_NAME", "name")
    known = reduce(or_, [(F.col("name") == h.name) & (F.col("LAST_LOAD_TIMESTAMP").cast("timestamp_ntz") == F.lit(h.last)) for h in heads])
    return found.where(known).select(
        "name",
        F.col("LAST_LOAD_TIMESTAMP").cast("timestamp_ntz").alias("last_load"),
        F.lit(min(h.loads for h in heads)).alias("loads"),
        F.lit(files).cast("long").alias("files"),
    )


@query(LATEST.format(keys="user_id", events="(SELECT * FROM events WHERE event_type <> 'error')"))
def full_refresh(spark, sf_dir):
    """A daily load after an older one: the table is replaced, the transform drops error events."""
    folder, events = scratch_path(spark, "refresh"), table(spark, sf_dir, "events")
    entity = _entity(
        folder, keys=["user_id"], incremental=False, transform="SELECT * FROM event WHERE event_type <> 'error'"
    )
    for until in ("2024-01-15", None):
        lake.load(spark, entity, _until(events, until), "daily", f"{folder}/ledger", AS_OF)
    return lake.current_state(spark, entity)


@query(
    "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' AND NOT (o_orderdate >= TIMESTAMP '1998-01-01' AND "
    "o_orderdate < TIMESTAMP '2000-01-01') UNION ALL SELECT * REPLACE ('B' AS o_orderstatus) FROM orders WHERE "
    "o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'"
)
def backfill_range(spark, sf_dir):
    """Orders loaded up to 1998, then 1998 and 1999 loaded again from a changed source."""
    folder, orders = scratch_path(spark, "backfill"), table(spark, sf_dir, "orders")
    entity = _entity(folder, name="Order", keys=["o_orderkey"], order=["o_orderdate"], watermark=None, incremental=False)
    lake.load(spark, entity, orders.where(F.col("o_orderdate") < "1999-01-01"), "daily", f"{folder}/ledger", AS_OF)
    changed = orders.withColumn("o_orderstatus", F.lit("B"))
    lake.backfill(spark, entity, changed, "o_orderdate", "1998-01-01", "2000-01-01")
    return lake.current_state(spark, entity)


@query("SELECT 'Event' AS table_name, 'Y' AS complete, count(*) AS row_count, max(ts) AS last_load FROM events")
def load_ledger(spark, sf_dir):
    """Ledger row of an hourly load that keeps every event."""
    folder = scratch_path(spark, "ledger")
    entity = _entity(folder, keys=["event_id"])
    lake.load(spark, entity, table(spark, sf_dir, "events"), "transactional", f"{folder}/ledger", AS_OF)
    return ledger.read(spark, f"{folder}/ledger").select(
        F.col("TABLE_NAME").alias("table_name"),
        F.col("LOAD_COMPLETE_FLAG").alias("complete"),
        F.col("ROW_COUNT").alias("row_count"),
        F.col("LAST_LOAD_TIMESTAMP").cast("timestamp_ntz").alias("last_load"),
    )


TARGET_COLUMNS = "c_custkey AS FacilityId, c_nationkey AS RouteId, c_mktsegment AS RouteCode, c_acctbal AS Balance"
GOVERNED = [3, 7, 11]


def _route_entity(**changes) -> DatabaseEntity:
    settings = dict(
        name="Route",
        table="stg_Route",
        write_mode="truncate_insert",
        transform=f"SELECT {TARGET_COLUMNS}, c_name FROM route",
        excluded_columns=["C_NAME"],
        suffix_columns=("RouteId", "RouteCode"),
        write_enabled=True,
    )
    return DatabaseEntity(**settings | changes)


ROUTES = (
    "SELECT c_custkey AS FacilityId, c_nationkey AS RouteId, CASE WHEN c_nationkey IN (3, 7, 11) THEN c_mktsegment || '-D' "
    "ELSE c_mktsegment END AS RouteCode, c_acctbal AS Balance FROM customer"
)


@query(ROUTES)
def truncate_insert_load(spark, sf_dir):
    """Loaded twice in chunks with suffixed codes: the second run replaces the first."""
    target = FolderTarget(scratch_path(spark, "database"))
    entity = _route_entity(chunk_column="routecode", chunks=3)
    for _ in range(2):
        database.load(spark, entity, table(spark, sf_dir, "customer"), target, "daily", f"{target.root}/ledger", AS_OF, GOVERNED)
    return spark.read.parquet(target.path(entity.table))


@query(f"SELECT * FROM ({ROUTES}) WHERE RouteId IN (0, 1, 2, 3, 4, 5, 6, 7)")
def initial_load(spark, sf_dir):
    """An initial load of a listed set of routes."""
    target = FolderTarget(scratch_path(spark, "database"))
    entity, ids = _route_entity(name="RouteInitialLoad", transform=f"SELECT {TARGET_COLUMNS}, c_name FROM routeinitialload"), range(8)
    customers = table(spark, sf_dir, "customer")
    database.load(
        spark, entity, customers, target, "initial", f"{target.root}/ledger", AS_OF, GOVERNED, ("c_nationkey", list(ids), "include")
    )
    return spark.read.parquet(target.path(entity.table))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def append_absent_load(spark, sf_dir):
    """Two transactional runs and a replay without a watermark: every event is inserted once."""
    target, events = FolderTarget(scratch_path(spark, "database")), table(spark, sf_dir, "events")
    entity = DatabaseEntity(
        name="Event",
        table="stg_Event",
        write_mode="append",
        dedupe_keys=["EVENT_ID"],
        watermark="ts",
        incremental=True,
        write_enabled=True,
    )
    for mode, until in (("transactional", "2024-01-16"), ("transactional", None), ("daily", None)):
        source = _until(events, until)
        database.load(spark, entity, source, target, mode, f"{target.root}/ledger", AS_OF)
    return spark.read.parquet(target.path(entity.table))


@query(
    "SELECT 'Customer' AS entity_name, 'success' AS status, count(*) AS row_count, 'overwrite' AS raw_mode, 'overwrite' AS "
    "current_mode FROM customer UNION ALL SELECT 'Order', 'success', count(*), 'overwrite', 'overwrite' FROM orders "
    "UNION ALL SELECT 'Supplier', 'skipped_empty', 0, '', ''"
)
def load_summary(spark, sf_dir):
    """Result summary of three daily loads, one of them without rows."""
    folder = scratch_path(spark, "summary")
    loads = {
        "Order": ("o_orderkey", table(spark, sf_dir, "orders")),
        "Customer": ("c_custkey", table(spark, sf_dir, "customer")),
        "Supplier": ("s_suppkey", table(spark, sf_dir, "supplier").where(F.col("s_suppkey") < 0)),
    }
    results = {}
    for name, (key, source) in loads.items():
        entity = _entity(f"{folder}/{name}", name=name, keys=[key], order=[], watermark=None, incremental=False)
        results[name] = lake.load(spark, entity, source, "daily", f"{folder}/ledger", AS_OF)
    return lake.load_summary(results, spark)


STREAM_FILES = 6


def _event_stream(spark, sf_dir, folder):
    """The events as a stream of files: written once in time order, at least six of them, read one at a time."""
    events = table(spark, sf_dir, "events")
    per_file = max(1, -(-events.count() // STREAM_FILES))
    events.repartitionByRange("ts").sortWithinPartitions("ts").write.option("maxRecordsPerFile", per_file).parquet(f"{folder}/input")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/input")


@query(LATEST.format(keys="user_id, event_type", events="events").replace(" FROM (SELECT", ", true AS in_batches FROM (SELECT", 1))
def stream_upsert_latest(spark, sf_dir):
    """Six batches or more, each but the first merged; the ledger has a row for each."""
    folder = scratch_path(spark, "stream")
    changes = _event_stream(spark, sf_dir, folder)
    target = f"{folder}/current"
    run = stream_upsert(
        changes, target, f"{folder}/checkpoint", ["user_id", "event_type"], ["ts", "event_id"], ledger_path=f"{folder}/ledger", buckets=16
    )
    run.awaitTermination()
    recorded = ledger.read(spark, f"{folder}/ledger").count()
    return read_bucketed(spark, target).withColumn("in_batches", F.lit(recorded >= STREAM_FILES))


@query("SELECT DISTINCT user_id, true AS in_batches FROM events")
def stream_dedupe_within(spark, sf_dir):
    """Six batches or more; what one has seen the next ones know from the state."""
    folder = scratch_path(spark, "stream")
    changes = _event_stream(spark, sf_dir, folder)
    kept = dedupe_within(changes, ["user_id"], "ts", "60 days").select("user_id")
    writer = kept.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    run = writer.trigger(availableNow=True).start()
    run.awaitTermination()
    filled = sum(p.numInputRows > 0 for p in run.recentProgress)
    return spark.read.schema(kept.schema).parquet(f"{folder}/out").withColumn("in_batches", F.lit(filled >= STREAM_FILES))
