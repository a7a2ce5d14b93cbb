"""Delete detection by reconciling held keys with the keys present at the source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import KEY_BUCKETS, key_bucket, timestamp_literal
from tidegate.operators.dedupe import distinct_keys
from tidegate.operators.filters import not_soft_deleted
from tidegate.operators.membership import exclude_keys, without_held
from tidegate.operators.names import not_null

# Buckets that keys are digested in; their numbers go through the driver.
DIGEST_BUCKETS = 1 << 12

# Column names of the snapshot and event tables.
SNAPSHOT_TS = "Snapshot_Timestamp"
DETECTED_TS = "Deleted_Detected_AtTimestamp"
DETECTED_DATE = "Deleted_Detected_Date"


def bucket_column(key: str) -> str:
    return f"{key}_Bucket"


def snapshot_schema(key: str = "Trip_ID", kind: T.DataType | None = None) -> T.StructType:
    return T.StructType([T.StructField(key, kind or T.IntegerType(), False), T.StructField(SNAPSHOT_TS, T.TimestampType(), False)])


def event_schema(key: str = "Trip_ID", kind: T.DataType | None = None) -> T.StructType:
    return T.StructType(
        [
            T.StructField(key, kind or T.IntegerType(), False),
            T.StructField(bucket_column(key), T.IntegerType(), False),
            T.StructField(DETECTED_TS, T.TimestampType(), False),
            T.StructField(DETECTED_DATE, T.DateType(), False),
        ]
    )


def source_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL keys present at the source now."""
    return distinct_keys(df, [key])


def held_keys(current: DataFrame, key: str, flag: str = "IS_DELETED") -> DataFrame:
    """Non-NULL keys of the current state that are not flagged as deleted, as often as they occur."""
    return not_null(not_soft_deleted(current, flag).select(key), [key])


def active_keys(current: DataFrame, key: str, flag: str = "IS_DELETED") -> DataFrame:
    """Distinct non-NULL keys of the current state that are not flagged as deleted."""
    return held_keys(current, key, flag).distinct()


def missing_keys(held: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Incremental candidates: distinct held keys that the source no longer has.

    Each side is shuffled once, for its distinct; the join reuses that partitioning.
    """
    return without_held(distinct_keys(held, [key]), source, [key])


def missing_keys_full(held: DataFrame, history: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Full candidates: keys of the current state or of history that the source no longer has."""
    return missing_keys(held.select(key).unionByName(history.select(key)), source, key)


def differing_buckets(left: DataFrame, right: DataFrame, key: str, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """The buckets of non-NULL keys in which two sides may differ.

    Each side's keys are counted and digested by bucket, whatever their order, and the digests of both are set off
    against each other in one aggregate: a map task sends one row a bucket, and nothing is joined. A key that one side repeats
    makes its bucket differ, so equal sets of distinct keys, and only they, have no differing bucket.
    """

    def digested(df: DataFrame, sign: int) -> DataFrame:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
        other = F.xxhash64(F.lit(1), key)
        # 32 bits of the hash can be summed over two billion keys.
        return df.where(F.col(key).isNotNull()).select(bucket, F.lit(sign).alias("n"), (other.bitwiseAND(F.lit(0xFFFFFFFF)) * sign).alias("s"), other.alias("x"))

    both = digested(left, 1).unionByName(digested(right, -1))
    sums = both.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.bit_xor("x").alias("x"))
    return sums.where("n <> 0 OR s <> 0 OR x <> 0").select("bucket")


def missing_by_digest(held: DataFrame, source: DataFrame, key: str, buckets: int = DIGEST_BUCKETS) -> DataFrame:
    """`missing_keys` that joins only the buckets in which the two sides differ.

    If there are none no join is started. Which buckets differ is found out at once, by a job over both sides; their
    numbers, ``buckets`` at most, come to the driver. Keys of different types are joined at once.
    """
    if held.schema[key].dataType != source.schema[key].dataType:
        return missing_keys(held, source, key)
    differ = [row["bucket"] for row in differing_buckets(held, source, key, buckets).collect()]
    if not differ:
        return held.select(key).where(F.lit(False))
    if 2 * len(differ) < buckets:
        inside = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").isin(differ)
        held, source = held.where(inside), source.where(inside)
    return missing_keys(held, source, key)


def merge_snapshot(snapshot: DataFrame, source: DataFrame, key: str, as_of: dt.datetime) -> DataFrame:
    """Key snapshot with the last-seen time of every source key moved to ``as_of``.

    One aggregate over both, so map tasks send one row a key and a key that either side repeats is one row. NULL keys
    of the snapshot stay, those of the source are ignored.
    """
    kind = snapshot.schema[SNAPSHOT_TS].dataType
    held = snapshot.select(key, SNAPSHOT_TS, F.lit(False).alias("__seen"))
    now = timestamp_literal(as_of).cast(kind)
    seen = source.where(F.col(key).isNotNull()).select(F.col(key).cast(snapshot.schema[key].dataType), F.lit(None).cast(kind).alias(SNAPSHOT_TS), F.lit(True).alias("__seen"))
    nullable = snapshot.schema[key].nullable
    both = (held.where(F.col(key).isNotNull()) if nullable else held).unionByName(seen)
    latest = both.groupBy(key).agg(F.max(SNAPSHOT_TS).alias("__held"), F.max("__seen").alias("__seen"))
    merged = latest.select(key, F.when(F.col("__seen"), now).otherwise(F.col("__held")).alias(SNAPSHOT_TS))
    return merged.unionByName(snapshot.where(F.col(key).isNull()).select(key, SNAPSHOT_TS)) if nullable else merged


def new_events(
    candidates: DataFrame, events: DataFrame, key: str, as_of: dt.datetime, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Events for candidates that have none yet, stamped ``as_of``, in the layout of ``events``.

    The bucket follows from the key, so the key alone decides whether an event exists.
    """
    bucket = bucket_column(key)
    typed = candidates.select(F.col(key).cast(events.schema[key].dataType).alias(key))
    fresh = without_held(distinct_keys(typed, [key]), events, [key])
    stamped = fresh.withColumn(DETECTED_TS, timestamp_literal(as_of))
    if bucket not in events.columns:
        return stamped
    return stamped.select(
        key, key_bucket([key], buckets).alias(bucket), DETECTED_TS, F.to_date(DETECTED_TS).alias(DETECTED_DATE)
    )


def latest_events(events: DataFrame, key: str) -> DataFrame:
    """One row per key with its latest detection time and date."""
    complete = events.where(F.col(key).isNotNull() & F.col(DETECTED_TS).isNotNull())
    latest = complete.groupBy(key).agg(F.max(DETECTED_TS).alias(DETECTED_TS))
    return latest.withColumn(DETECTED_DATE, F.to_date(DETECTED_TS))


def active_rows(current: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Current state without rows whose key has a delete event."""
    return exclude_keys(current, events, [key])


def retract_events(events: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Events without keys that are back at the source."""
    return exclude_keys(events, source, [key])


def bucketed_layout(events: DataFrame, key: str, as_of: dt.datetime, buckets: int = KEY_BUCKETS) -> DataFrame:
    """Rows of an old event table in the bucketed layout: NULL keys dropped, missing times filled."""
    detected = F.coalesce(F.col(DETECTED_TS), timestamp_literal(as_of))
    kept = events.where(F.col(key).isNotNull())
    return kept.select(
        key, key_bucket([key], buckets).alias(bucket_column(key)), detected.alias(DETECTED_TS), F.to_date(detected).alias(DETECTED_DATE)
    )
