"""Where a database load ends up: a JDBC database, or a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.merge import absent_rows
from tidegate.operators.names import resolve
from tidegate.sinks import jdbc
from tidegate.sinks.reach import Reach, reach_of
from tidegate.sinks.tables import write_table
from tidegate.sources.jdbc import Database
from tidegate.workspace import has_files, release, scratch_path, stage

CHUNK = "__chunk"


class Target(Protocol):
    def held_keys(self, spark: SparkSession, table: str, keys: Sequence[str], within: Reach | None = None) -> DataFrame | None:
        """Keys the table holds, of those ``within`` reach of a batch if it is given; None if there is no table yet."""

    def write(self, df: DataFrame, table: str, mode: str, rows: int | None, options: dict) -> None:
        """``append``, or ``truncate_insert`` to replace the rows."""


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of a database. Existing keys are read by one task for each predicate: the ``key_predicates``, disjoint ones
    that cover every row, or those that follow from the batch."""

    db: Database
    key_predicates: Sequence[str] = ()

    def held_keys(self, spark: SparkSession, table: str, keys: Sequence[str], within: Reach | None = None) -> DataFrame | None:
        return jdbc.target_keys(spark, self.db, table, keys, self.key_predicates, within)

    def write(self, df: DataFrame, table: str, mode: str, rows: int | None, options: dict) -> None:
        jdbc.write(df, self.db, table, mode, rows, options)


@dataclass(frozen=True)
class FolderTarget:
    """Tables as Parquet folders below ``root``. Unlike a database's, a failed insert leaves no rows."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def held_keys(self, spark: SparkSession, table: str, keys: Sequence[str], within: Reach | None = None) -> DataFrame | None:
        path = self.path(table)
        if not has_files(spark, path):
            return None
        held = spark.read.parquet(path).select(*keys)
        reached = within.condition(F.col(held.columns[0])) if within is not None else None
        return held if reached is None else held.where(reached)

    def write(self, df: DataFrame, table: str, mode: str, rows: int | None, options: dict) -> None:
        write_table(df, self.path(table), "append" if mode == "append" else "overwrite")


def chunk_of(df: DataFrame, column: str, chunks: int) -> DataFrame:
    """Rows with the number of the chunk their ``column`` hashes to."""
    (column,) = resolve(df, [column])
    return df.withColumn(CHUNK, F.pmod(F.hash(F.col(column)), F.lit(chunks)))


def write_chunks(
    df: DataFrame,
    target: Target,
    table: str,
    column: str | None = None,
    chunks: int = 1,
    mode: str = "append",
    rows: int | None = None,
    options: dict | None = None,
) -> int:
    """Write in ``chunks`` separate inserts by key hash; returns how many. One chunk is a plain write.

    The rows are first written to the shared folder partitioned by chunk, so each insert reads only
    its own chunk and all of them see the same rows.
    """
    if chunks <= 1:
        target.write(df, table, mode, rows, options or {})
        return 1
    spark = df.sparkSession
    placed, path = chunk_of(df, column, chunks), scratch_path(spark, "chunks")
    placed.hint("rebalance", F.col(CHUNK)).write.partitionBy(CHUNK).parquet(path)
    copy = spark.read.schema(placed.schema).parquet(path)
    per_chunk = None if rows is None else rows // chunks
    for chunk in range(chunks):
        part = copy.where(F.col(CHUNK) == chunk).drop(CHUNK)
        target.write(part, table, mode if chunk == 0 else "append", per_chunk, options or {})
    release(spark, path)
    return chunks


def append_absent(
    df: DataFrame,
    target: Target,
    table: str,
    keys: Sequence[str],
    options: dict | None = None,
    chunk_column: str | None = None,
    chunks: int = 1,
) -> int:
    """Append the rows, one per key, whose key the target does not hold; returns how many.

    Of the target only keys in reach of the batch are read. The new rows are written to the shared folder before the first insert, so the insert does not
    read the table it changes, and its size is known.
    """
    spark = df.sparkSession
    keys = resolve(df, keys)
    held = target.held_keys(spark, table, keys, reach_of(df, keys[0]))
    if held is None:
        held = df.select(*keys).where(F.lit(False))
    typed = [F.col(c).cast(df.schema[k].dataType).alias(k) for c, k in zip(resolve(held, keys), keys, strict=True)]
    new = stage(absent_rows(held.select(*typed), df, keys), "absent", F.count(F.lit(1)).alias("rows"))
    if new.metrics["rows"]:
        write_chunks(new.df, target, table, chunk_column or keys[0], chunks, "append", new.metrics["rows"], options)
    release(spark, new.path)
    return new.metrics["rows"]
