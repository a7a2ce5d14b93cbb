"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows that a Python task holds as objects at a time.
SLICE_ROWS = 512


PACKAGE = Path(__file__).parent.parent
# Applications whose Python workers have been given this package.
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package, however the driver came by it. Spark hands the archive on."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = f"{tempfile.mkdtemp(prefix='tidegate-')}/tidegate.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(
    df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable[..., tuple[Any, ...]]]
) -> DataFrame:
    """One output row per input row, by a Python function of ``columns``.

    ``make`` runs once per task and returns that function, so tables and caches live as long as
    the task. Rows travel in Arrow batches and become Python objects a slice at a time.
    """
    ship(df.sparkSession)
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                rows = [function(*row) for row in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                arrays = [pa.array(v, type=f.type) for v, f in zip(zip(*rows, strict=True), out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.select(*columns).mapInArrow(run, schema)


def spans_text(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` of (start, rank of kind, end), comma-joined in that order."""
    return ",".join(f"{kinds[kind]}:{start}:{end}" for start, kind, end in sorted(spans))
