"""The load-mode matrix on small tables."""

import datetime as dt

import pytest

from tidegate.plans import lake
from tidegate.plans.specs import LakeEntity
from tidegate.sinks import ledger
from tidegate.sinks.tables import read_bucketed, same_content
from tidegate.workspace import rename

AS_OF = dt.datetime(2024, 2, 1)


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def source(spark, *rows):
    return spark.createDataFrame([(k, v, at(m), at(0)) for k, v, m in rows], "k int, v string, UpdatedDateTime timestamp, CreatedDateTime timestamp")


def entity(folder, **changes):
    settings = dict(name="T", keys=["k"], raw_path=f"{folder}/raw", current_path=f"{folder}/cur", watermark="UpdatedDateTime", buckets=4)
    return LakeEntity(**settings | changes)


def run(spark, spec, src, mode="transactional", folder=None):
    return lake.load(spark, spec, src, mode, f"{spec.raw_path}-ledger", AS_OF)


def content(df):
    return sorted((r.k if r.k is not None else -1, r.v) for r in df.collect())


FIRST = [(1, "a", 1), (2, "b", 2), (2, "old", 1)]
SECOND = [(1, "a", 1), (2, "B", 5), (3, "c", 6)]


def test_daily_overwrites_both(spark, folder):
    spec = entity(folder)
    assert run(spark, spec, source(spark, *FIRST), "daily").raw_mode == "overwrite"
    result = run(spark, spec, source(spark, (9, "z", 1)), "daily")
    assert (result.raw_mode, result.current_mode, result.watermark) == ("overwrite", "overwrite", None)
    assert content(spark.read.parquet(spec.raw_path)) == content(lake.current_state(spark, spec)) == [(9, "z")]


def test_hourly_append_and_merge(spark, folder):
    spec = entity(folder, incremental=True)
    first = run(spark, spec, source(spark, *FIRST))
    assert (first.row_count, first.raw_mode, first.current_mode, first.watermark) == (2, "append", "overwrite", at(2))
    second = run(spark, spec, source(spark, *SECOND))
    assert (second.row_count, second.raw_mode, second.current_mode, second.watermark) == (2, "append", "merge", at(6))
    assert content(spark.read.parquet(spec.raw_path)) == [(1, "a"), (2, "B"), (2, "b"), (3, "c")]
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "B"), (3, "c")]
    again = run(spark, spec, source(spark, *SECOND))
    assert again.status == "skipped_empty"
    assert ledger.read(spark, f"{spec.raw_path}-ledger").count() == 2


def test_hourly_raw_merge_and_replicas(spark, folder):
    spec = entity(folder, incremental=True, raw_merge=True, raw_replica=f"{folder}/raw2", current_replica=f"{folder}/cur2")
    assert run(spark, spec, source(spark, *FIRST)).raw_mode == "append"
    assert run(spark, spec, source(spark, *SECOND)).raw_mode == "merge"
    expected = [(1, "a"), (2, "B"), (3, "c")]
    for path in (spec.raw_path, spec.current_path, spec.raw_replica, spec.current_replica):
        assert content(read_bucketed(spark, path)) == expected
    assert same_content(spark.read.parquet(spec.current_path), spark.read.parquet(spec.current_replica))


def test_first_current_state_reads_the_whole_source(spark, folder):
    spec = entity(folder, incremental=True)
    ledger.append(spark, f"{spec.raw_path}-ledger", "T", 1, at(4), AS_OF)
    result = run(spark, spec, source(spark, *SECOND))
    assert result.row_count == 2
    assert content(spark.read.parquet(spec.raw_path)) == [(2, "B"), (3, "c")]
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "B"), (3, "c")]


def test_watermark_falls_back_to_raw(spark, folder):
    spec = entity(folder, incremental=True)
    run(spark, entity(folder, grain="HOURLY"), source(spark, *FIRST), "daily")
    result = run(spark, spec, source(spark, *SECOND))
    assert result.row_count == 2


def test_hourly_grain_without_increment_keeps_deleted_rows(spark, folder):
    spec = entity(folder, grain="hourly")
    run(spark, spec, source(spark, *FIRST), "daily")
    result = run(spark, spec, source(spark, (3, "c", 3)), "daily")
    assert (result.raw_mode, result.current_mode) == ("overwrite", "merge")
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "b"), (3, "c")]


def test_empty_batch_writes_nothing(spark, folder):
    spec = entity(folder)
    run(spark, spec, source(spark, *FIRST), "daily")
    result = run(spark, spec, source(spark, (1, "x", 1)).where("k > 5"), "daily")
    assert result.status == "skipped_empty"
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "b")]


def test_refused_before_writing(spark, folder):
    src = source(spark, *FIRST)
    cases = [
        (entity(folder, incremental=True, grain="DAILY"), "transactional", "daily table"),
        (entity(folder, grain="WEEKLY"), "daily", "grain"),
        (entity(folder, write_enabled=False), "daily", "disabled"),
        (entity(folder, keys=[]), "daily", "key"),
        (entity(folder, incremental=True, watermark=None), "transactional", "watermark"),
        (entity(folder), "weekly", "mode"),
    ]
    for spec, mode, message in cases:
        with pytest.raises(ValueError, match=message):
            run(spark, spec, src, mode)
    with pytest.raises(Exception):
        spark.read.parquet(f"{folder}/raw")


def test_daily_append(spark, folder):
    spec = entity(folder, incremental=True, grain="DAILY", append_daily=True)
    run(spark, spec, source(spark, *FIRST))
    result = run(spark, spec, source(spark, *SECOND))
    assert (result.raw_mode, result.current_mode) == ("append", "append")
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "B"), (2, "b"), (3, "c")]


def test_transform_and_dedupe_keys(spark, folder):
    spec = entity(folder, transform=lambda df: df.where("v <> 'b'"))
    run(spark, spec, source(spark, *FIRST), "daily")
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "old")]


def test_backfill(spark, folder):
    spec = entity(folder)
    run(spark, spec, source(spark, *FIRST), "daily")
    changed = source(spark, (1, "A", 1), (2, "B", 2), (3, "C", 3))
    result = lake.backfill(spark, spec, changed, "k", 2, 4)
    assert (result.row_count, result.current_mode) == (2, "merge")
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "B"), (3, "C")]
    assert lake.backfill(spark, spec, changed, "k", 50).status == "skipped_empty"


def test_late_change_within_lookback(spark, folder):
    spec = entity(folder, incremental=True, lookback=dt.timedelta(minutes=3))
    run(spark, spec, source(spark, *SECOND))
    run(spark, spec, source(spark, *SECOND, (4, "late", 4)))
    assert (4, "late") in content(lake.current_state(spark, spec))


def test_summary(spark, folder):
    results = {"T": run(spark, entity(folder), source(spark, *FIRST), "daily")}
    assert [tuple(r) for r in lake.load_summary(results, spark).collect()] == [("T", "success", 2, "overwrite", "overwrite")]


def test_interrupted_replacement(spark, folder):
    """A half-written replacement is discarded; a swap that stopped half-way is undone."""
    spec = entity(folder)
    run(spark, spec, source(spark, *FIRST), "daily")
    for path in (spec.raw_path, spec.current_path):
        spark.range(3).write.parquet(f"{path}__new")
    run(spark, spec, source(spark, *SECOND), "daily")
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "B"), (3, "c")]
    rename(spark, spec.current_path, f"{spec.current_path}__old")
    result = lake.backfill(spark, spec, source(spark, (9, "z", 9)), "k")
    assert result.current_mode == "merge"
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "B"), (3, "c"), (9, "z")]
