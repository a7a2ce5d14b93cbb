"""Loads into a database: truncate and insert, append if absent, initial load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import with_suffix
from tidegate.operators.filters import HISTORY_MONTHS, after_watermark, history_window
from tidegate.operators.membership import IN_LIST_LIMIT, MEMBER, filter_by_ids, listed_ids, listed_values
from tidegate.operators.names import exclude_columns, resolve
from tidegate.plans.specs import DatabaseEntity, LoadResult
from tidegate.sinks import ledger
from tidegate.sinks.tables import transform
from tidegate.sinks.targets import Target, append_absent, write_chunks
from tidegate.workspace import release, stage


def extract(
    spec: DatabaseEntity,
    source: DataFrame,
    mode: str,
    as_of: dt.date,
    last: dt.datetime | None = None,
    id_filter: tuple[str, Sequence[int] | DataFrame, str] | None = None,
) -> DataFrame:
    """Rows an entity reads: history window, then watermark, then id filter (column, ids, mode).

    An initial load reads the whole history unless the entity keeps its window.
    """
    rows = source
    if spec.history_column:
        whole = mode == "initial" and not spec.keep_history_on_initial
        rows = history_window(rows, spec.history_column, as_of, None if whole else HISTORY_MONTHS)
    if spec.is_incremental(mode):
        rows = after_watermark(rows, spec.watermark, last, spec.lookback)
    if id_filter:
        column, ids, kind = id_filter
        if ids.isEmpty() if isinstance(ids, DataFrame) else not ids:
            raise ValueError(f"{spec.name}: the id filter has no ids")
        rows = filter_by_ids(rows, column, ids, kind)
    return rows


def suffix_governed(
    df: DataFrame, columns: tuple[str, str] | None, governed: Sequence[int] | DataFrame
) -> DataFrame:
    """Append the governed suffix to the code of governed ids. ``columns`` is (id, code).

    Names are matched exactly; without them, or without ids, the frame is unchanged. Ids are compared as
    in `filter_by_ids`, whatever the length of the list.
    """
    frame = isinstance(governed, DataFrame)
    if not columns or not set(columns) <= set(df.columns) or (not frame and not governed):
        return df
    id_column, code = columns
    if not frame and len(governed) <= IN_LIST_LIMIT:
        key, values = listed_values(df, id_column, governed)
        member = F.coalesce(key.isin(values), F.lit(False)) if values else F.lit(False)
        return df.withColumn(code, with_suffix(code, member))
    key, listed = listed_ids(df, id_column, governed)
    marked = df.withColumn(MEMBER, key).join(listed.withColumn("__governed", F.lit(True)), MEMBER, "left")
    return marked.withColumn(code, with_suffix(code, F.coalesce("__governed", F.lit(False)))).select(*df.columns)


def load(
    spark: SparkSession,
    spec: DatabaseEntity,
    source: DataFrame,
    target: Target,
    mode: str,
    ledger_path: str,
    as_of: dt.datetime,
    governed: Sequence[int] | DataFrame = (),
    id_filter: tuple[str, Sequence[int] | DataFrame, str] | None = None,
) -> LoadResult:
    """Load one entity into its target table.

    The completed rows are written once to the shared folder, which counts them and takes their
    watermark; the target is written from that copy, so counts and rows agree and the source is
    read once. ``append`` with dedupe keys inserts only rows whose key the target does not hold
    and never updates; without keys it appends everything. The ledger row comes last.
    """
    if not spec.write_enabled:
        return LoadResult(spec.name, "skipped")
    spec.check(mode)
    incremental = spec.is_incremental(mode)
    name = ledger.ledger_name(spec.name, spec.ledger_name)
    last = ledger.last_watermark(spark, ledger_path, name) if incremental else None
    rows = extract(spec, source, mode, as_of.date(), last, id_filter)
    rows = suffix_governed(transform(rows, spec.transform, spec.name.lower()), spec.suffix_columns, governed)

    metrics = [F.count(F.lit(1)).alias("rows")]
    if incremental:
        (column,) = resolve(rows, [spec.watermark])
        metrics.append(F.max(F.col(column).cast("timestamp_ntz")).alias("watermark"))
    done = stage(rows, spec.name.lower(), *metrics)
    count = done.metrics["rows"]
    out = exclude_columns(done.df, spec.excluded_columns)
    options = dict(spec.options)
    if spec.write_mode == "append" and spec.dedupe_keys:
        count = append_absent(out, target, spec.table, spec.dedupe_keys, options, spec.chunk_column, spec.chunks)
    else:
        write_chunks(out, target, spec.table, spec.chunk_column, spec.chunks, spec.write_mode, count, options)

    watermark = done.metrics.get("watermark")
    if incremental:
        ledger.append(spark, ledger_path, name, done.metrics["rows"], watermark, as_of)
    release(spark, done.path)
    return LoadResult(spec.name, "written_in_chunks" if spec.chunks > 1 else "written", count, current_mode=spec.write_mode, watermark=watermark)
