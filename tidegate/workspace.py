"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Folders made for local sessions that name none, by application.
_local_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", name: str = "tidegate", **conf: Any) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, from ``spark.checkpoint.dir``.

    Only a local master may run without it: executors on other hosts could not read a folder of
    the driver's machine, so anywhere else a missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="tidegate-")
    return _local_folders[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; never reused, so concurrent runs cannot meet."""
    return f"{shared_dir(spark)}/tidegate/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Staged:
    """A written intermediate table and the metrics observed while it was written."""

    df: DataFrame
    path: str
    metrics: dict[str, Any]


def stage(df: DataFrame, label: str, *metrics: Column, path: str | None = None) -> Staged:
    """Write ``df`` to the shared folder once and read it back.

    This is how lineage is cut and how an expensive input is read only once: the copy survives lost
    executors. The metrics are collected by the write itself, so they describe exactly what was
    written and need no second scan.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    observed = Observation()
    if metrics:
        df = df.observe(observed, *metrics)
    df.write.mode("errorifexists").parquet(path)
    return Staged(spark.read.schema(df.schema).parquet(path), path, observed.get if metrics else {})


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) for a location, for the few steps Spark has no API for."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder fits a glob pattern."""
    fs, target = hadoop_path(spark, pattern)
    return bool(fs.globStatus(target))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds data; an empty one has no schema to infer."""
    return matches(spark, f"{path}/[^_.]*")


def release(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that are no longer read."""
    for path in paths:
        fs, target = hadoop_path(spark, path)
        fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = hadoop_path(spark, source)
    if not fs.rename(source_path, hadoop_path(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files or folders that fit a glob pattern, sorted."""
    fs, target = hadoop_path(spark, pattern)
    return sorted(status.getPath().getName() for status in fs.globStatus(target) or [])


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if there is none."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file so that readers see the old one or the new one, whole."""
    beside = f"{path}.{uuid.uuid4().hex}"
    fs, new = hadoop_path(spark, beside)
    stream = fs.create(new, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    _, target = hadoop_path(spark, path)
    context = hadoop.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(target), options)
