"""Parquet, catalog and id-list sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.names import resolve
from tidegate.workspace import exists


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table. A declared schema avoids inference and lets an empty table be read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or a (global) temp view."""
    return spark.table(name)


def sql_source(spark: SparkSession, text: str) -> DataFrame:
    """A source given as SQL over tables and views of this session."""
    return spark.sql(text)


def id_list(spark: SparkSession, path: str, field: str | None = "route_ids", kind: str = "bigint", required: bool = False) -> DataFrame:
    """Distinct ids of a list file, as one column ``id``.

    A ``.json`` file is an object with an array under ``field``, or a bare array; any other file
    has one id per line, with an optional trailing comma. Blank entries are skipped, numbers
    trimmed; text ids are taken as they are. A missing or empty list is an empty frame, or an
    error if the list is ``required``.
    """
    if not exists(spark, path):
        if required:
            raise ValueError(f"id list '{path}' was not found")
        return spark.createDataFrame([], f"id {kind}")
    if path.lower().endswith(".json"):
        text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
        listed = F.from_json("value", f"struct<`{field}`: array<string>>")[field]
        items = F.when(F.col("value").startswith("["), F.from_json("value", "array<string>")).otherwise(listed)
        raw = text.select(F.explode(items).alias("id"))
    else:
        raw = spark.read.text(path).select(F.rtrim(F.trim("value"), F.lit(",")).alias("id"))
    if kind == "string":
        ids = raw.where(F.col("id") != "")
    else:
        ids = raw.where(F.trim("id") != "").select(F.trim("id").cast(kind).alias("id"))
    ids = ids.distinct()
    if required and ids.isEmpty():
        raise ValueError(f"id list '{path}' does not contain any ids")
    return ids


def keyset(df: DataFrame, key: str, kind: str = "decimal(38,0)") -> DataFrame:
    """Distinct non-NULL values of a business key in the type shared by all key sets."""
    (name,) = resolve(df, [key])
    return df.select(F.col(name).cast(kind).alias(key)).where(F.col(key).isNotNull()).distinct()
