"""The load ledger: one row per finished load with its watermark.

The rows are an append-only log of Parquet files, folded into one whenever they have become many. Beside it each
name has a head, a small file with its latest complete watermark, so a load opens one file however long the log is.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import EPOCH
from tidegate.operators.names import resolve
from tidegate.workspace import exists, folder_names, hadoop_path, read_text, release, rename, write_text

# Files after which the log is folded, and seconds after which a fold that has not finished counts as dead.
FOLD_FILES, FOLD_SECONDS = 128, 3_600

# The ledger's columns. The row count is a BIGINT, as a large load exceeds an INT.
SCHEMA = T.StructType(
    [
        T.StructField("TABLE_NAME", T.StringType()),
        T.StructField("LOAD_DATE", T.TimestampType()),
        T.StructField("LOAD_COMPLETE_FLAG", T.StringType()),
        T.StructField("ROW_COUNT", T.LongType()),
        T.StructField("LAST_LOAD_TIMESTAMP", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Head:
    """What the log says of one name.

    ``pending`` is a row that the head has and the log may not have yet: a run died between the two.
    """

    name: str
    watermark: str | None = None
    loads: int = 0
    batch: int | None = None
    pending: dict | None = None

    @property
    def last(self) -> dt.datetime | None:
        return None if self.watermark is None else dt.datetime.fromisoformat(self.watermark)


def ledger_name(entity: str, configured: str | None = None, default: str | None = None) -> str:
    """Name under which an entity is tracked, the same for reading and writing."""
    return (configured or default or entity).strip()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; empty if none has been written yet. Any other read error is raised."""
    finish_fold(spark, path)
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def _head_path(path: str, name: str) -> str:
    return f"{path}__heads/{hashlib.md5(name.encode()).hexdigest()}.json"


def _write_head(spark: SparkSession, path: str, head: Head) -> None:
    write_text(spark, _head_path(path, head.name), json.dumps(asdict(head)))


def head_of(spark: SparkSession, path: str, name: str) -> Head:
    """The head of a name. A log that is older than heads is read once for it, and so is one to which a pending row
    may be missing."""
    text = read_text(spark, _head_path(path, name))
    if text is not None:
        return _settled(spark, path, Head(**json.loads(text)))
    complete = read(spark, path).where(F.col("LOAD_COMPLETE_FLAG") == "Y")
    number = F.regexp_extract("TABLE_NAME", r"#(\d+)$", 1).try_cast("long")
    own = F.when(F.col("TABLE_NAME") == name, F.col("LAST_LOAD_TIMESTAMP").cast("timestamp_ntz"))
    batches = F.when(F.col("TABLE_NAME").startswith(f"{name}#"), number)
    found = complete.agg(F.max(own).alias("last"), F.count(own).alias("loads"), F.max(batches).alias("batch")).first()
    head = Head(name, found["last"] and found["last"].isoformat(sep=" "), found["loads"], found["batch"])
    if found["loads"] or found["batch"] is not None:
        _write_head(spark, path, head)
    return head


def _settled(spark: SparkSession, path: str, head: Head) -> Head:
    """The head after its pending row is in the log for certain."""
    if head.pending is None:
        return head
    row, settled = head.pending, replace(head, pending=None)
    log = read(spark, path)
    same = (F.col("TABLE_NAME") == row["name"]) & (F.col("LAST_LOAD_TIMESTAMP").cast("string") == F.lit(row["watermark"]).cast("timestamp").cast("string"))
    same &= F.col("LOAD_DATE").cast("string") == F.lit(row["as_of"]).cast("timestamp").cast("string")
    if log.where(same).isEmpty():
        _log(spark, path, row)
    _write_head(spark, path, settled)
    return settled


def forget_head(spark: SparkSession, path: str, name: str) -> None:
    """Let the next load read the log, after rows were taken out of it by hand."""
    release(spark, _head_path(path, name))


def complete_watermarks(ledger: DataFrame) -> DataFrame:
    """Latest watermark of every entity over its complete loads."""
    complete = ledger.where(F.col("LOAD_COMPLETE_FLAG") == "Y")
    return complete.groupBy("TABLE_NAME").agg(F.max("LAST_LOAD_TIMESTAMP").alias("LAST_LOAD_TIMESTAMP"))


def max_watermark(df: DataFrame, column: str) -> dt.datetime | None:
    (column,) = resolve(df, [column])
    return df.agg(F.max(F.col(column).cast("timestamp_ntz"))).first()[0]


def last_watermark(
    spark: SparkSession,
    path: str,
    name: str,
    fallback: DataFrame | None = None,
    fallback_column: str | None = None,
    default: dt.datetime = EPOCH,
) -> dt.datetime:
    """Watermark to extract from: the ledger's, else the highest in the loaded table, else ``default``."""
    found = head_of(spark, path, name).last
    if found is None and fallback is not None and fallback_column:
        found = max_watermark(fallback, fallback_column)
    return default if found is None else found


def append(
    spark: SparkSession,
    path: str,
    name: str,
    rows: int,
    watermark: dt.datetime | None,
    as_of: dt.datetime,
    complete: bool = True,
    stream: str | None = None,
    batch: int | None = None,
) -> bool:
    """Record a load; nothing is written, and False returned, when it has no watermark, or when it is a ``batch`` of a
    ``stream`` that is recorded already.

    The head comes first and holds the row until the log has it, so a run that dies in between leaves the row neither
    out nor twice in.
    """
    if watermark is None:
        return False
    row = {
        "name": name,
        "as_of": as_of.isoformat(sep=" "),
        "flag": "Y" if complete else "N",
        "rows": rows,
        "watermark": watermark.isoformat(sep=" "),
    }
    if not complete:
        _log(spark, path, row)
        return True
    head = head_of(spark, path, stream or name)
    if batch is not None and head.batch is not None and batch <= head.batch:
        return False
    latest = watermark if head.last is None else max(watermark, head.last)
    new = Head(head.name, latest.isoformat(sep=" "), head.loads + 1, head.batch if batch is None else batch, row)
    _write_head(spark, path, new)
    _log(spark, path, row)
    _write_head(spark, path, replace(new, pending=None))
    if len(_log_files(spark, path)) > FOLD_FILES:
        fold(spark, path)
    return True


def _log(spark: SparkSession, path: str, row: dict) -> None:
    spark.range(1).select(
        F.lit(row["name"]).alias("TABLE_NAME"),
        F.lit(row["as_of"]).cast("timestamp").alias("LOAD_DATE"),
        F.lit(row["flag"]).alias("LOAD_COMPLETE_FLAG"),
        F.lit(row["rows"]).cast("bigint").alias("ROW_COUNT"),
        F.lit(row["watermark"]).cast("timestamp").alias("LAST_LOAD_TIMESTAMP"),
    ).coalesce(1).write.mode("append").parquet(path)


def _log_files(spark: SparkSession, path: str) -> list[str]:
    return folder_names(spark, f"{path}/[^_.]*")


def fold(spark: SparkSession, path: str) -> bool:
    """Replace the files of the log by one with the same rows; False while another run does.

    The new file is written beside the log with a list of those that it replaces. Then it is moved in and they are
    deleted; a run that dies in between is finished by the next reader. Rows added meanwhile are in other files.
    """
    beside = f"{path}__fold"
    finish_fold(spark, path)
    if exists(spark, beside):
        fs, target = hadoop_path(spark, beside)
        if time.time() - fs.getFileStatus(target).getModificationTime() / 1000 < FOLD_SECONDS:
            return False
        release(spark, beside)
    names = _log_files(spark, path)
    if not names:
        return False
    log = spark.read.schema(SCHEMA).parquet(*[f"{path}/{n}" for n in names])
    log.coalesce(1).write.parquet(f"{beside}/rows")
    write_text(spark, f"{beside}/_finished", json.dumps(names))
    finish_fold(spark, path)
    return True


def finish_fold(spark: SparkSession, path: str) -> None:
    """Put a folded log in the place of the files it replaces; run again after a crash it goes on where it stopped."""
    beside = f"{path}__fold"
    text = read_text(spark, f"{beside}/_finished")
    if text is None:
        return
    for name in folder_names(spark, f"{beside}/rows/[^_.]*"):
        rename(spark, f"{beside}/rows/{name}", f"{path}/{name}")
    release(spark, *[f"{path}/{name}" for name in json.loads(text)])
    release(spark, beside)
