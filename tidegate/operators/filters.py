"""Row predicates of an extract."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.names import resolve

# Fixed value: months of history a regular load keeps.
HISTORY_MONTHS = 48


def watermark_literal(data_type: T.DataType, value: dt.datetime | str) -> Column:
    """A watermark as a literal of the column's own type, so the comparison reaches the scan.

    A text column holds formatted times and is compared as text with microseconds.
    """
    stamp = dt.datetime.fromisoformat(value) if isinstance(value, str) else value
    if isinstance(data_type, T.StringType):
        return F.lit(stamp.strftime("%Y-%m-%d %H:%M:%S.%f"))
    return F.lit(stamp.isoformat(sep=" ")).cast(data_type)


def after_watermark(
    df: DataFrame, column: str, last: dt.datetime | str | None, lookback: dt.timedelta = dt.timedelta(0)
) -> DataFrame:
    """Rows changed strictly after ``last``; all rows when there is no watermark yet.

    ``lookback`` moves the bound back to catch late commits; it needs a replay-safe sink.
    """
    if not column or not column.strip():
        raise ValueError("an incremental extract needs a watermark column")
    if last is None or (isinstance(last, str) and not last.strip()):
        return df
    (column,) = resolve(df, [column])
    stamp = dt.datetime.fromisoformat(last.strip()) if isinstance(last, str) else last
    return df.where(F.col(column) > watermark_literal(df.schema[column].dataType, stamp - lookback))


def history_window(df: DataFrame, column: str, as_of: dt.date, months: int | None = HISTORY_MONTHS) -> DataFrame:
    """Rows not older than ``months`` before ``as_of``; ``None`` (an initial load) keeps everything."""
    if months is None:
        return df
    (column,) = resolve(df, [column])
    oldest = F.add_months(F.lit(as_of), F.lit(-months))
    return df.where(F.col(column) >= oldest.cast(df.schema[column].dataType))


def between_bounds(df: DataFrame, column: str, low: Any = None, high: Any = None) -> DataFrame:
    """Backfill range ``low <= column < high`` by time or id; either bound may be missing."""
    (column,) = resolve(df, [column])
    kind = df.schema[column].dataType
    if low is not None:
        df = df.where(F.col(column) >= F.lit(low).cast(kind))
    if high is not None:
        df = df.where(F.col(column) < F.lit(high).cast(kind))
    return df


def not_soft_deleted(df: DataFrame, flag: str = "IS_DELETED") -> DataFrame:
    """Rows whose delete flag is false or missing; unchanged if there is no such column."""
    match = [c for c in df.columns if c.lower() == flag.lower()]
    return df.where(~F.coalesce(F.col(match[0]), F.lit(False))) if match else df


def preview(df: DataFrame, rows: int | str | None, when_unset: int | None = None) -> DataFrame | None:
    """First rows of a stage for display: unset shows ``when_unset`` rows (all if None), <= 0 none."""
    if rows in (None, ""):
        return df if when_unset is None else df.limit(when_unset)
    return df.limit(int(rows)) if int(rows) > 0 else None
