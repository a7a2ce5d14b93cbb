"""JDBC sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidegate.sinks.reach import Reach
from tidegate.sources.jdbc import Database, key_scan

# Write tasks by row count, largest first; rows per insert batch.
WRITE_PARTITIONS = ((5_000_000, 64), (2_000_000, 48), (1_000_000, 32), (250_000, 16), (50_000, 8))
LARGE_WRITE = 1_000_000
BATCH_SIZES = {"large": 20_000, "normal": 10_000}


def write_partitions(rows: int | None) -> int | None:
    """Number of write tasks for a row count; None leaves the frame as it is partitioned."""
    return next((n for least, n in WRITE_PARTITIONS if rows is not None and rows >= least), None)


def write_options(rows: int | None, options: dict[str, object] | None = None) -> dict[str, str]:
    """Sizing options of a write; configured ones win.

    The isolation level defaults to READ_COMMITTED, so each task inserts in one transaction and a
    task that is lost and run again does not leave half of its rows behind. ``NONE`` is faster but
    may repeat rows after a lost executor.
    """
    size = BATCH_SIZES["large" if rows is not None and rows >= LARGE_WRITE else "normal"]
    chosen = {"batchsize": str(size), "isolationLevel": "READ_COMMITTED"}
    tasks = write_partitions(rows)
    if tasks:
        chosen["numPartitions"] = str(tasks)
    return chosen | {k: str(v) for k, v in (options or {}).items()}


def sized(df: DataFrame, options: dict[str, str]) -> DataFrame:
    return df.repartition(int(options["numPartitions"])) if "numPartitions" in options else df


def write(df: DataFrame, db: Database, table: str, mode: str = "append", rows: int | None = None, options: dict | None = None) -> None:
    """Append to a table, or clear it and insert (``truncate_insert``).

    Clearing truncates and keeps the table's definition. It is not atomic: a failed insert leaves
    the table empty or partly filled, and the load has to be run again.
    """
    if mode not in ("append", "truncate_insert"):
        raise ValueError(f"unsupported write mode '{mode}', expected 'append' or 'truncate_insert'")
    sizing = write_options(rows, options)
    writer = sized(df, sizing).write.format("jdbc").options(**db.jdbc_options()).options(**sizing).option("dbtable", table)
    if mode == "append":
        writer.mode("append").save()
    else:
        writer.mode("overwrite").option("truncate", "true").save()


def target_keys(
    spark: SparkSession,
    db: Database,
    table: str,
    keys: Sequence[str],
    predicates: Sequence[str] = (),
    within: Reach | None = None,
) -> DataFrame:
    """Distinct keys the target holds; with ``within`` only those a batch can meet.

    They are read by one task per predicate. Predicates that are given must be disjoint and together cover every row, such as
    ranges or remainders of a key; else they follow from the batch.
    """
    if not predicates and within is not None:
        predicates = within.predicates(keys[0])
    return key_scan(spark, db, f"SELECT * FROM {table}", keys, predicates)
