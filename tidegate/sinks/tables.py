"""Parquet table sinks and maintenance."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import KEY_BUCKETS, key_bucket
from tidegate.operators.deletes import bucket_column, bucketed_layout
from tidegate.operators.merge import merge_latest, upsert
from tidegate.operators.names import align, comparable, comparable_columns
from tidegate.workspace import exists, folder_names, hadoop_path, has_files, make_folder, release, rename, stage

BUCKET = "__bucket"
# Bytes that a bucket and a file of a compacted table are to hold.
BUCKET_BYTES, FILE_BYTES = 1 << 30, 256 << 20
LARGEST_BUCKETS = 1 << 16
# An empty, hidden file whose name keeps a table's number of buckets.
LAYOUT = "_buckets-"
FINISHED = "_finished"
# An empty, hidden file that is new after each swap, and how often a reader lists files anew because of it.
SWAP, LISTINGS = "_swap-", 3
# The folder of an appended batch: the watermark that it starts from, and a token of the run that wrote it.
BATCH = "__batch"
WHOLE = "b00000000T000000000000-whole"
# Folders that are renamed at a time.
RENAMES = 16


def holds_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table folder has files, or folders of a layout."""
    return has_files(spark, path) or bool(folder_names(spark, f"{path}/__*=*"))


def check_columns(spark: SparkSession, path: str, df: DataFrame) -> None:
    """Fail if rows of ``df`` have other columns than the table they are added to: Spark would write
    them and then show either schema, whichever file it looks at first."""
    if not holds_rows(spark, path):
        return
    held, given = ({c.lower() for c in frame.columns} for frame in (spark.read.parquet(path).drop(BATCH), df))
    if held != given:
        raise ValueError(f"{path} and the rows to add differ in columns {sorted(held ^ given)}")


def write_table(df: DataFrame, path: str, mode: str, *metrics: Column, partition_by: Sequence[str] = ()) -> dict:
    """Append to or overwrite a table. Returns metrics of the write.

    The schema is that of ``df``; appended rows must have the table's columns.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unsupported write mode '{mode}'")
    if mode == "append":
        check_columns(df.sparkSession, path, df)
    observed = Observation()
    writer = df.observe(observed, *(metrics or [F.count(F.lit(1)).alias("rows")])).write.mode(mode).option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return observed.get


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> bool:
    """Create an empty table; False if there is one already. Read it with the same schema.

    A table partitioned by columns starts as an empty folder, since Spark writes no file for it.
    """
    if exists(spark, path):
        return False
    if partition_by:
        fs, target = hadoop_path(spark, path)
        return bool(fs.mkdirs(target))
    spark.createDataFrame([], schema).write.parquet(path)
    return True


def by_bucket(df: DataFrame, bucket: str) -> DataFrame:
    """Rows gathered by bucket for writing. Adaptive execution splits large buckets over several
    tasks and joins small ones, so file sizes follow the advisory partition size."""
    return df.hint("rebalance", F.col(bucket))


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files of a table."""
    fs, target = hadoop_path(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def buckets_for(size: int, target: int = BUCKET_BYTES) -> int:
    """The power of two of buckets, KEY_BUCKETS at least, that holds ``size`` bytes at ``target`` each."""
    wanted = KEY_BUCKETS
    while wanted < LARGEST_BUCKETS and wanted * target < size:
        wanted *= 2
    return wanted


def held_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of buckets kept with a table, None if it keeps none."""
    fs, pattern = hadoop_path(spark, f"{path}/{LAYOUT}*")
    found = list(fs.globStatus(pattern) or [])
    return int(found[0].getPath().getName()[len(LAYOUT) :]) if found else None


def _touch(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.create(target).close()


def keep_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Note the number of buckets with a table."""
    held = held_buckets(spark, path)
    if held is not None and held != buckets:
        raise ValueError(f"{path} has {held} buckets, not {buckets}")
    if held is None:
        _touch(spark, f"{path}/{LAYOUT}{buckets}")


def write_bucketed(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int = KEY_BUCKETS, mode: str = "overwrite"
) -> dict:
    """Write a table laid out by key bucket, the layout `merge_into` needs."""
    spark = df.sparkSession
    if mode == "append":
        buckets = held_buckets(spark, path) or buckets
    placed = by_bucket(df.withColumn(BUCKET, key_bucket(keys, buckets)), BUCKET)
    metrics = write_table(placed, path, mode, partition_by=[BUCKET])
    keep_buckets(spark, path, buckets)
    return metrics


def replace_bucketed(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    buckets: int = KEY_BUCKETS,
    bucket_bytes: int = BUCKET_BYTES,
) -> dict:
    """Write a whole bucketed table beside its place and swap it in, so that a run that dies leaves
    either the old table or none, never a part.

    What is written decides the number of buckets: if it is more than the ``buckets`` given hold, they are split
    before the swap.
    """
    new = f"{path}__new"
    release(spark, new, f"{path}__split")
    metrics = write_bucketed(df, new, keys, buckets)
    factor = _growth(spark, new, buckets, bucket_bytes)
    if factor > 1:
        _write_split(spark, new, f"{path}__split", keys, buckets * factor)
        release(spark, new)
        rename(spark, f"{path}__split", new)
    publish(spark, new, path)
    return metrics


def _growth(spark: SparkSession, path: str, buckets: int, bucket_bytes: int) -> int:
    """The power of two by which a table's buckets are too few."""
    size, factor = table_bytes(spark, path), 1
    while buckets * factor * bucket_bytes < size and buckets * factor < LARGEST_BUCKETS:
        factor *= 2
    return factor


def _write_split(spark: SparkSession, path: str, target: str, keys: Sequence[str], buckets: int) -> None:
    """Write the rows of a bucketed table into a multiple of its buckets.

    The rows of a bucket go to few others, its number plus multiples of the old count, so each task writes its own and nothing
    is shuffled.
    """
    rows = spark.read.parquet(path).withColumn(BUCKET, key_bucket(keys, buckets))
    write_table(rows, target, "overwrite", partition_by=[BUCKET])
    keep_buckets(spark, target, buckets)


def grow_buckets(spark: SparkSession, path: str, keys: Sequence[str], bucket_bytes: int = BUCKET_BYTES) -> int:
    """Split the buckets of a table that has outgrown them, until each holds about ``bucket_bytes``; returns their number.

    Bucket b of n becomes b and b + n, by the next bit of the key's hash. The table is written anew only when its size has
    doubled, so growing costs a constant number of writes a row; merges in between rewrite what they touch. The new number
    is kept with the table and swapped in with it.
    """
    restore_table(spark, path)
    held = held_buckets(spark, path)
    if held is None:
        raise ValueError(f"{path} keeps no number of buckets")
    factor = _growth(spark, path, held, bucket_bytes)
    if factor == 1:
        return held
    new = f"{path}__new"
    release(spark, new)
    _write_split(spark, path, new, keys, held * factor)
    publish(spark, new, path)
    return held * factor


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a bucketed or batched table, without the columns of its layout.

    They are those before a merge or those after it: while finished buckets are being swapped in, or if the run that did so
    has died, reading is an error, and if a swap began and ended while the files were listed, they are listed again.
    `restore_table`, which every load calls first, finishes the swap of a dead run.
    """
    for _ in range(LISTINGS):
        before = _swaps(spark, path)
        if not exists(spark, f"{path}__merge/{FINISHED}"):
            rows = spark.read.parquet(path).drop(BUCKET, BATCH)
            if not exists(spark, f"{path}__merge/{FINISHED}") and _swaps(spark, path) == before:
                return rows
    raise RuntimeError(f"buckets of {path} are being swapped in; read it again, or call restore_table if the run has died")


def _swaps(spark: SparkSession, path: str) -> list[str]:
    """Hidden files, of which each swap of buckets leaves another."""
    return folder_names(spark, f"{path}/{SWAP}*")


def batches(spark: SparkSession, path: str) -> list[str]:
    """The batch folders of a table, in order."""
    return folder_names(spark, f"{path}/{BATCH}=*")


def put_batch(spark: SparkSession, df: DataFrame, path: str, start: dt.datetime, partition_by: Sequence[str] = ()) -> str:
    """Append a batch in a folder that is named by the watermark it starts from; returns the folder's name.

    A batch that starts from the same watermark, as a replay after a crash does, takes the place of the one before. The
    folder is written beside the table and renamed into it, so readers see all of it or nothing. Its name holds a token of
    the run, by which `replicate` tells it from the one it replaced. Rows that a table holds outside any batch become one.
    """
    restore_table(spark, path)
    held = batches(spark, path)
    if not held and holds_rows(spark, path):
        _adopt(spark, path)
    check_columns(spark, path, df)
    address = f"{BATCH}=b{start:%Y%m%dT%H%M%S%f}-"
    name, beside = f"{address}{uuid.uuid4().hex[:12]}", f"{path}__batch"
    release(spark, beside)
    write_table(df, f"{beside}/{name}", "overwrite", partition_by=partition_by)
    release(spark, *[f"{path}/{old}" for old in held if old.startswith(address)])
    make_folder(spark, path)
    rename(spark, f"{beside}/{name}", f"{path}/{name}")
    release(spark, beside)
    return name


def _adopt(spark: SparkSession, path: str) -> None:
    """Make the rows of a table without batches its first batch, by two renames of folders."""
    buckets = held_buckets(spark, path)
    rename(spark, path, f"{path}__adopt")
    _finish_adoption(spark, path)
    if buckets is not None:
        keep_buckets(spark, path, buckets)


def _finish_adoption(spark: SparkSession, path: str) -> None:
    if exists(spark, f"{path}__adopt"):
        make_folder(spark, path)
        rename(spark, f"{path}__adopt", f"{path}/{BATCH}={WHOLE}")


def settled_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """What a batched table holds for certain where no ledger says which loads have ended: all but the last batch, which
    a run that died may have left. All rows of a table without batches; None if there are no such rows."""
    held = batches(spark, path)
    if not held:
        return spark.read.parquet(path) if holds_rows(spark, path) else None
    sure = [name for name in held if name != held[-1] or name.endswith(WHOLE)]
    if not sure:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/{name}" for name in sure])


def sync_batches(spark: SparkSession, source: str, target: str) -> list[str]:
    """Make a copy hold the batches of its source: copy those it lacks, drop those the source no longer has.

    Batches are compared by folder name, which is new for each run that wrote one, so a copy that fell behind in any way
    catches up, and one that did not costs a listing. Returns the copied names.
    """
    restore_table(spark, target)
    held, wanted = batches(spark, target), batches(spark, source)
    if not held and holds_rows(spark, target):
        release(spark, target)
    make_folder(spark, target)
    release(spark, *[f"{target}/{name}" for name in held if name not in wanted])
    missing = [name for name in wanted if name not in held]
    beside = f"{target}__batch"
    for name in missing:
        release(spark, beside)
        rows = spark.read.parquet(f"{source}/{name}")
        write_table(rows, f"{beside}/{name}", "overwrite", partition_by=[BUCKET] if BUCKET in rows.columns else [])
        rename(spark, f"{beside}/{name}", f"{target}/{name}")
    release(spark, beside)
    buckets = held_buckets(spark, source)
    if buckets is not None:
        keep_buckets(spark, target, buckets)
    return missing


def _key_bytes(df: DataFrame, keys: Sequence[str]) -> Column:
    """Bytes of a row's key: the text length of text columns, 16 for any other."""
    sizes = [F.octet_length(k) if isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType)) else F.lit(16) for k in keys]
    return sum((F.coalesce(size, F.lit(0)) for size in sizes), F.lit(0))


def _broadcast_limit(spark: SparkSession) -> int:
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return -1 if setting.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)


def _split_merge(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The merge for a change set whose keys are small enough to send to every task, so that the base
    rows are matched where they were read."""
    changed = changes.select(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(keys)]).distinct()
    pairs = [(F.col(k), F.col(f"__c{i}")) for i, k in enumerate(keys)]
    on = [ours.eqNullSafe(theirs) if order else ours == theirs for ours, theirs in pairs]
    untouched = base.join(F.broadcast(changed), on, "left_anti")
    if order:
        changes = merge_latest(base.join(F.broadcast(changed), on, "left_semi"), changes, keys, order)
    return untouched.unionByName(changes)


def _placed(base: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The same rows; reading one that is in another bucket than its key says is an error, as it
    shows that the table was written with other keys or another number of buckets."""
    strayed = F.col(BUCKET) != key_bucket(keys, buckets)
    message = F.lit(f"table is not laid out in {buckets} buckets of {list(keys)}")
    return base.where(F.when(strayed, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def put_buckets(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Replace those buckets of a table that ``rows`` holds.

    They are written beside the table, marked as finished, and then take the places of the old ones
    folder by folder. A run that dies before the mark has changed nothing; after it, `restore_table`
    finishes the swap. Files are gathered by bucket, so rewriting does not multiply them.
    """
    beside = f"{path}__merge"
    release(spark, beside)
    by_bucket(rows, BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(beside)
    _touch(spark, f"{beside}/{FINISHED}")
    _swap_buckets(spark, path)


def _swap_buckets(spark: SparkSession, path: str) -> None:
    """Move finished buckets into a table, several at a time; run again after a crash it goes on where it stopped."""
    beside, old = f"{path}__merge", f"{path}__merged"
    make_folder(spark, old)
    before = _swaps(spark, path)
    _touch(spark, f"{path}/{SWAP}{uuid.uuid4().hex}")

    def swap(bucket: str) -> None:
        if exists(spark, f"{path}/{bucket}") and not exists(spark, f"{old}/{bucket}"):
            rename(spark, f"{path}/{bucket}", f"{old}/{bucket}")
        rename(spark, f"{beside}/{bucket}", f"{path}/{bucket}")

    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(swap, folder_names(spark, f"{beside}/{BUCKET}=*")))
    release(spark, beside, old, *[f"{path}/{name}" for name in before])


def finish_merge(spark: SparkSession, path: str) -> None:
    """Swap in what a merge has finished and not swapped in yet."""
    if exists(spark, f"{path}__merge/{FINISHED}"):
        _swap_buckets(spark, path)


def merge_into(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    buckets: int | None = None,
    order: Sequence[str] = (),
    staged: bool = False,
) -> list[int]:
    """Merge ``updates`` into a bucketed table by rewriting only the buckets they touch.

    Without ``order`` a matched row is updated whatever it holds (`upsert`), and a non-NULL key that
    occurs twice is an error before anything is written; with ``order`` the newer row wins
    (`merge_latest`). The touched buckets are written beside the table and swapped in (`put_buckets`),
    so lost executors, retried tasks and a lost driver leave the old rows or the new ones. Applying the
    same updates again changes nothing. Pass ``staged`` if ``updates`` is a written table already. The
    number of buckets is the one kept with the table; ``buckets`` is for tables that keep none. Returns
    the touched buckets, at most as many numbers.

    The changed keys are counted per bucket first. If together they stay below the session's
    broadcast threshold, base rows are matched where they are read; beyond it both sides are joined
    by shuffle.
    """
    restore_table(spark, path)
    held = held_buckets(spark, path)
    if held is not None and buckets is not None and held != buckets:
        raise ValueError(f"table is not laid out in {buckets} buckets of {list(keys)}, but in {held}")
    buckets = held or buckets or KEY_BUCKETS
    table = spark.read.parquet(path)
    kept = T.StructType([f for f in table.schema.fields if f.name != BUCKET])
    changes = align(updates, kept).withColumn(BUCKET, key_bucket(keys, buckets))
    copy = None if staged else stage(changes, "updates")
    changes = changes if copy is None else copy.df
    try:
        present = reduce(and_, [F.col(k).isNotNull() for k in keys])
        per_key = changes.groupBy(BUCKET, *keys).agg(
            F.first(_key_bytes(changes, keys)).alias("bytes"), F.count_if(present).alias("n")
        )
        sizes = per_key.groupBy(BUCKET).agg(F.sum("bytes").alias("bytes"), F.max("n").alias("n")).collect()
        repeated = [row[BUCKET] for row in sizes if row["n"] > 1]
        if repeated and not order:
            example = per_key.where("n > 1").drop(BUCKET, "bytes", "n").first()
            raise ValueError(f"duplicate merge key {example.asDict()} in {len(repeated)} buckets")
        touched = sorted(row[BUCKET] for row in sizes)
        if touched:
            base = _placed(table.where(F.col(BUCKET).isin(touched)), keys, buckets)
            changes = changes.select(*base.columns)
            if sum(row["bytes"] for row in sizes) <= _broadcast_limit(spark):
                merged = _split_merge(base, changes, keys, order)
            elif order:
                merged = merge_latest(base, changes, keys, order)
            else:
                merged = upsert(base, changes, keys, updates_are_unique=True)
            put_buckets(spark, merged, path)
            if held is None:
                keep_buckets(spark, path, buckets)
    finally:
        if copy is not None:
            release(spark, copy.path)
    return touched


def replace_table(spark: SparkSession, path: str, df: DataFrame, partition_by: Sequence[str] = ()) -> dict:
    """Replace a table by a frame that may read it: write beside it, then swap the folders.

    A run that died between the two renames is completed by the next one. A number of buckets kept
    with the table stays with it. Returns metrics of the write.
    """
    new = f"{path}__new"
    restore_table(spark, path)
    buckets = held_buckets(spark, path)
    metrics = write_table(df, new, "overwrite", partition_by=partition_by)
    if buckets is not None and BUCKET in partition_by:
        keep_buckets(spark, new, buckets)
    publish(spark, new, path)
    return metrics


def publish(spark: SparkSession, new: str, path: str) -> None:
    """Put a written table in the place of another, or in a free place."""
    old = f"{path}__old"
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, new, path)
    release(spark, old)


def restore_table(spark: SparkSession, path: str) -> None:
    """Undo a swap of tables that stopped half-way, and finish one of buckets or of a first batch."""
    _finish_adoption(spark, path)
    if not exists(spark, path) and exists(spark, f"{path}__old"):
        rename(spark, f"{path}__old", path)
    elif exists(spark, f"{path}__old"):
        release(spark, f"{path}__old")
    finish_merge(spark, path)
    if exists(spark, f"{path}__merge"):
        release(spark, f"{path}__merge")


def replicate(
    spark: SparkSession, source: str, target: str, buckets: Sequence[int] | None = None, added: DataFrame | None = None
) -> None:
    """Copy a table to a second location: whole, only the key buckets a merge has touched, only the rows that an append
    has ``added``, or, of a table of batches, those that the copy lacks.

    A copy that is missing, or has another number of buckets than its source, is written whole.
    """
    restore_table(spark, target)
    if batches(spark, source):
        sync_batches(spark, source, target)
        return
    if added is not None and exists(spark, target):
        write_table(added, target, "append")
        return
    rows = spark.read.parquet(source)
    if BUCKET not in rows.columns:
        replace_table(spark, target, rows)
    elif buckets is not None and exists(spark, target) and held_buckets(spark, source) == held_buckets(spark, target):
        if buckets:
            put_buckets(spark, rows.where(F.col(BUCKET).isin(list(buckets))), target)
    else:
        _copy_buckets(spark, source, target)


def _copy_buckets(spark: SparkSession, source: str, target: str) -> None:
    """A whole copy of a bucketed table; its files are bucketed already, so nothing is shuffled."""
    held, new = held_buckets(spark, source), f"{target}__new"
    write_table(spark.read.parquet(source), new, "overwrite", partition_by=[BUCKET])
    if held is not None:
        keep_buckets(spark, new, held)
    publish(spark, new, target)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-independent checksum, for comparing a copy with its source.

    Maps count by their sorted entries, where keys and values can be sorted.
    """
    values = [F.col(c) for c in sorted(comparable_columns(df))]
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        if isinstance(field.dataType, T.MapType) and all(map(comparable, (field.dataType.keyType, field.dataType.valueType))):
            values.append(F.array_sort(F.map_entries(field.name)))
    total = F.sum(F.xxhash64(*values).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(total, F.lit(0)).cast("string").alias("checksum"))


def same_content(left: DataFrame, right: DataFrame) -> bool:
    return fingerprint(left).first() == fingerprint(right).first()


def cluster_by_key(df: DataFrame, keys: Sequence[str], files: int) -> DataFrame:
    """Rows in ``files`` key ranges, sorted within each, so readers skip files by min/max of the key.

    Ranges may end within a key: the rows of a hot one are dealt on by a hash of their other columns.
    """
    others = comparable_columns(df, keys)
    spread = [F.xxhash64(*[F.col(c) for c in others])] if others else []
    return df.repartitionByRange(files, *keys, *spread).sortWithinPartitions(*keys)


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    files: int | None = None,
    partition_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> None:
    """Rewrite a table into few files clustered by key; as many of ``file_bytes`` as its bytes ask for if not told.

    A bucketed table keeps its buckets.
    """
    restore_table(spark, path)
    rows = spark.read.parquet(path)
    if not partition_by and BUCKET in rows.columns:
        partition_by = [BUCKET]
    if partition_by:
        clustered = rows.hint("rebalance", *[F.col(c) for c in partition_by]).sortWithinPartitions(*partition_by, *keys)
    else:
        clustered = cluster_by_key(rows, keys, files or max(1, -(-table_bytes(spark, path) // file_bytes)))
    replace_table(spark, path, clustered, partition_by)


def migrate_events(spark: SparkSession, path: str, key: str, as_of: dt.datetime, buckets: int = KEY_BUCKETS) -> bool:
    """Move an event table to the bucketed layout; False if it has it already."""
    restore_table(spark, path)
    events = spark.read.parquet(path)
    bucket = bucket_column(key)
    if {bucket.lower(), "deleted_detected_date"} <= {c.lower() for c in events.columns}:
        return False
    replace_table(spark, path, by_bucket(bucketed_layout(events, key, as_of, buckets), bucket), [bucket])
    return True


def stage_view(df: DataFrame, name: str) -> None:
    """Expose a stage result as a temp view and a global temp view, for SQL transforms."""
    df.createOrReplaceTempView(name)
    df.createOrReplaceGlobalTempView(name)


def transform(df: DataFrame, rule: str | Callable[[DataFrame], DataFrame] | None, view: str) -> DataFrame:
    """The transform of an entity: SQL over the stage views, a function, or nothing."""
    if rule is None:
        return df
    if callable(rule):
        return rule(df)
    stage_view(df, view)
    return df.sparkSession.sql(rule)
