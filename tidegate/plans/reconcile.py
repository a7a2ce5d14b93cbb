"""Delete detection over stored tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import KEY_BUCKETS
from tidegate.operators import deletes
from tidegate.sinks.tables import (
    FILE_BYTES,
    by_bucket,
    compact,
    create_if_absent,
    migrate_events,
    replace_table,
    restore_table,
    write_table,
)
from tidegate.workspace import has_files, matches, release, stage

MODES = ("incremental", "full")


@dataclass(frozen=True)
class DeleteTables:
    """Where delete detection keeps its state, and the key it works on."""

    snapshot: str
    events: str
    current_events: str
    key: str = "Trip_ID"
    soft_flag: str = "IS_DELETED"
    buckets: int = KEY_BUCKETS


@dataclass(frozen=True)
class DeleteResult:
    migrated: bool
    source_count: int
    candidate_count: int
    new_events: int
    current_events: int


def detect(
    spark: SparkSession,
    tables: DeleteTables,
    source: DataFrame,
    current: DataFrame,
    as_of: dt.datetime,
    mode: str = "incremental",
    history: DataFrame | None = None,
    migrate: bool = False,
    retract: bool = False,
) -> DeleteResult:
    """One reconciliation run.

    Source keys are read once; the last-seen snapshot moves to ``as_of``; keys held in ``current``
    (and, in ``full`` mode, in ``history``) but gone from the source get an event unless they have
    one. A key that comes back keeps its event unless ``retract`` is set. Counts are taken while
    the rows are written. Running it again on the same input adds nothing.
    """
    if mode not in MODES:
        raise ValueError(f"unsupported reconcile mode '{mode}', expected one of {MODES}")
    if mode == "full" and history is None:
        raise ValueError("a full reconcile needs the history")
    key, bucket = tables.key, deletes.bucket_column(tables.key)
    kind = source.schema[key].dataType
    snapshot_schema, event_schema = deletes.snapshot_schema(key, kind), deletes.event_schema(key, kind)
    for path in (tables.snapshot, tables.events):
        restore_table(spark, path)
    create_if_absent(spark, tables.snapshot, snapshot_schema)
    create_if_absent(spark, tables.events, event_schema, [bucket])
    migrated = migrate and has_files(spark, tables.events) and migrate_events(spark, tables.events, key, as_of, tables.buckets)

    counted = F.count(F.lit(1)).alias("rows")
    keys = stage(deletes.source_keys(source, key), "source-keys", counted)
    snapshot = spark.read.schema(snapshot_schema).parquet(tables.snapshot)
    replace_table(spark, tables.snapshot, deletes.merge_snapshot(snapshot, keys.df, key, as_of))

    held = deletes.held_keys(current, key, tables.soft_flag)
    if mode == "full":
        held = held.select(key).unionByName(history.select(key))
        missing = deletes.missing_keys(held, keys.df, key)
    else:
        # Key by key the current state mostly equals its source; of buckets with equal digests none is joined.
        missing = deletes.missing_by_digest(held, keys.df, key)
    candidates = stage(missing, "delete-candidates", counted)
    events = _events(spark, tables, event_schema)
    if retract:
        replace_table(spark, tables.events, by_bucket(deletes.retract_events(events, keys.df, key), bucket), [bucket])
        events = spark.read.schema(event_schema).parquet(tables.events)
    fresh = stage(
        deletes.new_events(candidates.df, events, key, as_of, tables.buckets), "delete-events", counted
    )
    if fresh.metrics["rows"]:
        if bucket in fresh.df.columns:
            write_table(by_bucket(fresh.df, bucket), tables.events, "append", partition_by=[bucket])
        else:
            write_table(fresh.df, tables.events, "append")
    latest = deletes.latest_events(_events(spark, tables, event_schema), key)
    synced = replace_table(spark, tables.current_events, latest)["rows"]
    release(spark, keys.path, candidates.path, fresh.path)
    return DeleteResult(migrated, keys.metrics["rows"], candidates.metrics["rows"], fresh.metrics["rows"], synced)


def _events(spark: SparkSession, tables: DeleteTables, schema: T.StructType) -> DataFrame:
    """Events in the layout they are stored in: bucketed, or the old one with key and time only."""
    bucketed = matches(spark, f"{tables.events}/{deletes.bucket_column(tables.key)}=*")
    if bucketed or not has_files(spark, tables.events):
        return spark.read.schema(schema).parquet(tables.events)
    return spark.read.parquet(tables.events)


def active_view(spark: SparkSession, name: str, current: DataFrame, tables: DeleteTables) -> DataFrame:
    """Current state without deleted keys, also registered as the view ``name``."""
    kind = current.schema[tables.key].dataType
    events = _events(spark, tables, deletes.event_schema(tables.key, kind)).select(F.col(tables.key).cast(kind))
    rows = deletes.active_rows(current, events, tables.key)
    rows.createOrReplaceTempView(name)
    return rows


def optimize(spark: SparkSession, tables: DeleteTables, files: int | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Compact the state tables and cluster them by key, into files by their bytes unless told."""
    bucket = deletes.bucket_column(tables.key)
    compact(spark, tables.snapshot, [tables.key], files, file_bytes=file_bytes)
    if has_files(spark, tables.events):
        compact(spark, tables.events, [tables.key], files, [bucket])
    compact(spark, tables.current_events, [tables.key], files, file_bytes=file_bytes)
