"""Micro-batch variants of the loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions import KEY_BUCKETS
from tidegate.operators.dedupe import dedupe_latest
from tidegate.sinks import ledger
from tidegate.sinks.tables import merge_into, replace_bucketed, restore_table
from tidegate.workspace import exists, release, stage


def upsert_batch(
    target: str,
    keys: Sequence[str],
    order: Sequence[str],
    ledger_path: str | None = None,
    name: str = "stream",
    watermark: str | None = None,
    buckets: int = KEY_BUCKETS,
    now: Callable[[], dt.datetime] = dt.datetime.now,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the latest row per key in a bucketed table.

    The newer row wins whichever batch brings it, so a batch that is replayed or arrives late
    changes nothing it should not. The ledger has one row per batch, under ``name#batch``.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamp = F.max(F.col(watermark or order[0]).cast("timestamp_ntz")).alias("watermark")
        latest = stage(dedupe_latest(batch, keys, order), "batch", F.count(F.lit(1)).alias("rows"), stamp)
        if latest.metrics["rows"]:
            restore_table(spark, target)
            if exists(spark, target):
                merge_into(spark, target, latest.df, keys, order=order, staged=True)
            else:
                replace_bucketed(spark, latest.df, target, keys, buckets)
            if ledger_path:
                metrics = latest.metrics
                entry = f"{name}#{batch_id}"
                ledger.append(spark, ledger_path, entry, metrics["rows"], metrics["watermark"], now(), stream=name, batch=batch_id)
        release(spark, latest.path)

    return apply


def stream_upsert(
    changes: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], **options
) -> StreamingQuery:
    """Apply a stream of changes to a bucketed table, batch by batch, until the input is used up.

    Run it again with the same ``checkpoint`` to take what has arrived since.
    """
    writer = changes.writeStream.foreachBatch(upsert_batch(target, keys, order, **options))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedupe_within(changes: DataFrame, keys: Sequence[str], time_column: str, lateness: str) -> DataFrame:
    """One row per key among rows that arrive within ``lateness`` of each other, with bounded state.

    The first row to arrive is kept; use `stream_upsert` where the latest must win.
    """
    timed = changes.withColumn(time_column, F.col(time_column).cast("timestamp"))
    return timed.withWatermark(time_column, lateness).dropDuplicatesWithinWatermark(list(keys))
