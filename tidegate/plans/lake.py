"""Loads into the lake: incremental, full refresh, backfill."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import key_bucket
from tidegate.operators.dedupe import dedupe_latest
from tidegate.operators.filters import after_watermark, between_bounds
from tidegate.plans.specs import LakeEntity, LoadResult
from tidegate.sinks import ledger
from tidegate.sinks.tables import (
    BUCKET,
    buckets_for,
    by_bucket,
    grow_buckets,
    held_buckets,
    keep_buckets,
    merge_into,
    publish,
    put_batch,
    read_bucketed,
    replace_bucketed,
    replicate,
    restore_table,
    settled_rows,
    table_bytes,
    transform,
)
from tidegate.workspace import Staged, exists, release, stage


def _one_per_key(spec: LakeEntity, rows: DataFrame) -> DataFrame:
    return dedupe_latest(transform(rows, spec.transform, spec.name.lower()), spec.dedupe_keys or spec.keys, spec.order)


def _stage_batch(spec: LakeEntity, rows: DataFrame, path: str | None = None) -> Staged:
    """Read, transform and dedupe the extract once; count it and take its watermark on the way."""
    batch = _one_per_key(spec, rows)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if spec.watermark:
        metrics.append(F.max(F.col(spec.watermark).cast("timestamp_ntz")).alias("watermark"))
    return stage(batch, spec.name.lower(), *metrics, path=path)


def _raw_mode(spec: LakeEntity, incremental: bool, existed: bool, grain: str) -> str:
    if not incremental:
        return "overwrite"
    return "merge" if spec.raw_merge and existed and (grain == "HOURLY" or spec.append_daily) else "append"


def load(
    spark: SparkSession,
    spec: LakeEntity,
    source: DataFrame,
    mode: str,
    ledger_path: str,
    as_of: dt.datetime,
) -> LoadResult:
    """Load one entity from ``source``, the whole source relation, of which Spark reads what it needs.

    | mode, grain                     | raw                               | current state            |
    | ---                             | ---                               | ---                      |
    | any but transactional, DAILY    | overwrite                         | overwrite                |
    | any but transactional, HOURLY   | overwrite                         | merge (first: overwrite) |
    | transactional increment, HOURLY | append, or merge with `raw_merge` | merge (first: full read) |
    | transactional increment, DAILY  | refused, or both appended with `append_daily`               ||

    The deduped extract is written once to the shared folder and read from there; where it replaces
    the raw table it is written beside it and takes its place. An empty batch writes nothing. Appended increments
    are batches in folders that the watermark they start from names. The ledger row comes last, so a run that dies
    is repeated from the same watermark, puts the same folders in the place of what it left, and every sink here
    holds the same rows again. A replica gets what it lacks, so it equals its source after each load that ends. Buckets
    that a table has outgrown are split after the merge.
    """
    spec.check(mode)
    grain, incremental = spec.grain_for(mode), spec.is_incremental(mode)
    name = ledger.ledger_name(spec.name, spec.ledger_name)
    last = None
    rows = source
    for path in (spec.raw_path, spec.current_path):
        restore_table(spark, path)
    if incremental:
        held = settled_rows(spark, spec.raw_path)
        last = ledger.last_watermark(spark, ledger_path, name, held, spec.watermark)
        rows = after_watermark(source, spec.watermark, last, spec.lookback)

    raw_mode = _raw_mode(spec, incremental, exists(spark, spec.raw_path), grain)
    whole_raw = f"{spec.raw_path}__new" if raw_mode == "overwrite" and not spec.raw_merge else None
    if whole_raw:
        release(spark, whole_raw)
    batch = _stage_batch(spec, rows, whole_raw)
    count = batch.metrics["rows"]
    if count == 0:
        release(spark, batch.path)
        return LoadResult(spec.name, "skipped_empty")

    # At first the number of buckets follows the batch; a table that turns out larger has them split.
    buckets = spec.buckets or buckets_for(table_bytes(spark, batch.path))
    raw_touched = None
    if whole_raw:
        publish(spark, whole_raw, spec.raw_path)
        batch = Staged(spark.read.schema(batch.df.schema).parquet(spec.raw_path), whole_raw, batch.metrics)
    elif raw_mode == "merge":
        raw_touched = merge_into(spark, spec.raw_path, batch.df, spec.keys, staged=True)
    elif spec.raw_merge:
        replace_bucketed(spark, batch.df, spec.raw_path, spec.keys, buckets, spec.bucket_bytes)
    else:
        put_batch(spark, batch.df, spec.raw_path, last)
    if spec.raw_merge:
        grow_buckets(spark, spec.raw_path, spec.keys, spec.bucket_bytes)
    if spec.raw_replica:
        replicate(spark, spec.raw_path, spec.raw_replica, raw_touched)

    touched = None
    if grain == "DAILY" and incremental:
        current_mode = "append"
        kept = held_buckets(spark, spec.current_path) or buckets
        placed = by_bucket(batch.df.withColumn(BUCKET, key_bucket(spec.keys, kept)), BUCKET)
        put_batch(spark, placed, spec.current_path, last, [BUCKET])
        keep_buckets(spark, spec.current_path, kept)
    elif grain == "DAILY":
        current_mode = "overwrite"
        replace_bucketed(spark, batch.df, spec.current_path, spec.keys, buckets, spec.bucket_bytes)
    elif not exists(spark, spec.current_path):
        current_mode = "overwrite"
        first = _one_per_key(spec, source) if incremental else batch.df
        replace_bucketed(spark, first, spec.current_path, spec.keys, buckets, spec.bucket_bytes)
    else:
        current_mode = "merge"
        touched = merge_into(spark, spec.current_path, batch.df, spec.keys, staged=True)
        grow_buckets(spark, spec.current_path, spec.keys, spec.bucket_bytes)
    if spec.current_replica:
        replicate(spark, spec.current_path, spec.current_replica, touched)

    watermark = None
    if incremental:
        found = batch.metrics["watermark"]
        watermark = max(found, last) if found is not None else None
        ledger.append(spark, ledger_path, name, count, watermark, as_of)
    release(spark, batch.path)
    return LoadResult(spec.name, "success", count, raw_mode, current_mode, watermark, touched)


def backfill(
    spark: SparkSession, spec: LakeEntity, source: DataFrame, column: str, low: Any = None, high: Any = None
) -> LoadResult:
    """Reload one range of the source and upsert it into the current state. The ledger is left alone."""
    spec.check("historical")
    restore_table(spark, spec.current_path)
    batch = _stage_batch(spec, between_bounds(source, column, low, high))
    count = batch.metrics["rows"]
    if count == 0:
        release(spark, batch.path)
        return LoadResult(spec.name, "skipped_empty")
    touched, current_mode = None, "overwrite"
    if exists(spark, spec.current_path):
        current_mode = "merge"
        touched = merge_into(spark, spec.current_path, batch.df, spec.keys, staged=True)
        grow_buckets(spark, spec.current_path, spec.keys, spec.bucket_bytes)
    else:
        buckets = spec.buckets or buckets_for(table_bytes(spark, batch.path))
        replace_bucketed(spark, batch.df, spec.current_path, spec.keys, buckets, spec.bucket_bytes)
    if spec.current_replica:
        replicate(spark, spec.current_path, spec.current_replica, touched)
    release(spark, batch.path)
    return LoadResult(spec.name, "success", count, current_mode=current_mode, touched=touched)


def current_state(spark: SparkSession, spec: LakeEntity) -> DataFrame:
    return read_bucketed(spark, spec.current_path)


def load_summary(results: Mapping[str, LoadResult], spark: SparkSession) -> DataFrame:
    """Summary of finished loads, ordered by entity."""
    rows = [(r.entity_name, r.status, r.row_count, r.raw_mode, r.current_mode) for r in results.values()]
    return spark.createDataFrame(
        rows, "entity_name string, status string, row_count bigint, raw_mode string, current_mode string"
    ).orderBy("entity_name")
