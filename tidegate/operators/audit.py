"""Load reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import format_watermark
from tidegate.operators.names import resolve


@dataclass(frozen=True)
class Audited:
    """A loaded table with its key and, if it has one, its watermark column."""

    df: DataFrame
    keys: Sequence[str]
    watermark: str | None = None


def load_audit(tables: Mapping[str, Audited]) -> DataFrame:
    """Row, key and duplicate-key counts and the latest change of every table, ordered by name."""

    def report(name: str, table: Audited) -> DataFrame:
        stamp = F.max(table.watermark) if table.watermark else F.lit(None).cast("timestamp_ntz")
        per_key = table.df.groupBy(*resolve(table.df, table.keys)).agg(F.count(F.lit(1)).alias("n"), stamp.alias("seen"))
        return per_key.agg(
            F.lit(name).alias("entity_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count(F.lit(1)).alias("key_count"),
            F.count_if(F.col("n") > 1).alias("duplicate_key_count"),
            format_watermark(F.max("seen")).alias("max_watermark"),
        )

    return reduce(DataFrame.unionByName, [report(n, t) for n, t in tables.items()]).orderBy("entity_name")


def load_report(spark: SparkSession, counts: Mapping[str, int | None]) -> DataFrame:
    """(entity_name, row_count) of a finished stage, ordered by entity."""
    rows = [(name, None if n is None else int(n)) for name, n in counts.items()]
    return spark.createDataFrame(rows, "entity_name string, row_count bigint").orderBy("entity_name")
