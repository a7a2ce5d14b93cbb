import datetime as dt

import pytest

from tidegate.operators import deletes
from tidegate.plans.reconcile import DeleteTables, active_view, detect, optimize
from tidegate.sinks.tables import create_if_absent, migrate_events, write_table

T0, T1, T2 = (dt.datetime(2024, 1, d, 22, 30) for d in (1, 2, 3))


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "Trip_ID int")


def current(spark, *values, deleted=()):
    rows = [(v, True if v in deleted else None) for v in values]
    return spark.createDataFrame(rows, "Trip_ID int, IS_DELETED boolean")


def found(df):
    return sorted(r.Trip_ID for r in df.collect())


def test_candidates(spark):
    source = deletes.source_keys(keys(spark, 1, 1, None), "Trip_ID")
    active = deletes.active_keys(current(spark, 1, 2, 3), "Trip_ID")
    assert found(deletes.missing_keys(active, source, "Trip_ID")) == [2, 3]
    assert found(deletes.missing_keys_full(active, keys(spark, 1, 4, 4, None), source, "Trip_ID")) == [2, 3, 4]
    flagged = deletes.active_keys(current(spark, 1, 2, 3, deleted=[3]), "Trip_ID")
    assert found(deletes.missing_keys(flagged, source, "Trip_ID")) == [2]


def test_snapshot(spark):
    held = spark.createDataFrame([(1, T0), (2, T0)], "Trip_ID int, Snapshot_Timestamp timestamp")
    merged = deletes.merge_snapshot(held, keys(spark, 1, 3), "Trip_ID", T1)
    assert sorted((r.Trip_ID, r.Snapshot_Timestamp) for r in merged.collect()) == [(1, T1), (2, T0), (3, T1)]


def tables(folder):
    return DeleteTables(f"{folder}/snapshot", f"{folder}/events", f"{folder}/current")


def events(spark, state):
    rows = spark.read.parquet(state.current_events).collect()
    return {r.Trip_ID: r.Deleted_Detected_AtTimestamp for r in rows}


def test_runs(spark, folder):
    state = tables(folder)
    held = current(spark, 1, 2, 3)
    first = detect(spark, state, keys(spark, 1, 3), held, T0)
    assert (first.source_count, first.candidate_count, first.new_events, first.current_events) == (2, 1, 1, 1)
    again = detect(spark, state, keys(spark, 1, 3), held, T1)
    assert (again.candidate_count, again.new_events) == (1, 0)
    full = detect(spark, state, keys(spark, 1, 2), held, T1, "full", keys(spark, 1, 4))
    assert (full.candidate_count, full.new_events) == (2, 2)
    assert events(spark, state) == {2: T0, 3: T1, 4: T1}
    assert found(active_view(spark, "active_trips", held, state)) == [1]
    assert found(spark.table("active_trips")) == [1]
    optimize(spark, state)
    assert events(spark, state) == {2: T0, 3: T1, 4: T1}
    snapshot = {r.Trip_ID: r.Snapshot_Timestamp for r in spark.read.parquet(state.snapshot).collect()}
    assert snapshot == {1: T1, 2: T1, 3: T1}


def test_reappeared_key(spark, folder):
    state, held = tables(folder), current(spark, 1, 2)
    detect(spark, state, keys(spark, 1), held, T0)
    detect(spark, state, keys(spark, 1, 2), held, T1)
    assert set(events(spark, state)) == {2}
    detect(spark, state, keys(spark, 1, 2), held, T2, retract=True)
    assert events(spark, state) == {}
    detect(spark, state, keys(spark, 1), held, T2, retract=True)
    assert events(spark, state) == {2: T2}


def test_modes_are_checked(spark, folder):
    with pytest.raises(ValueError, match="mode"):
        detect(spark, tables(folder), keys(spark, 1), current(spark, 1), T0, "partial")
    with pytest.raises(ValueError, match="history"):
        detect(spark, tables(folder), keys(spark, 1), current(spark, 1), T0, "full")


@pytest.mark.parametrize("migrate", [True, False])
def test_old_layout(spark, folder, migrate):
    state = tables(folder)
    old = spark.createDataFrame([(1, T0), (2, None), (None, T0)], "Trip_ID int, Deleted_Detected_AtTimestamp timestamp")
    write_table(old, state.events, "overwrite")
    result = detect(spark, state, keys(spark, 9), current(spark, 5, 9), T1, migrate=migrate)
    assert result.migrated is migrate and result.new_events == 1
    if migrate:
        stored = spark.read.parquet(state.events)
        assert {r.Trip_ID: r.Deleted_Detected_AtTimestamp for r in stored.collect()} == {1: T0, 2: T1, 5: T1}
        assert stored.where("Trip_ID_Bucket IS NULL OR Deleted_Detected_Date IS NULL").count() == 0
        assert not migrate_events(spark, state.events, "Trip_ID", T2)
    else:
        assert events(spark, state) == {1: T0, 5: T1}


def test_create_if_absent(spark, folder):
    schema = deletes.snapshot_schema()
    assert create_if_absent(spark, f"{folder}/t", schema)
    assert not create_if_absent(spark, f"{folder}/t", schema)
    assert spark.read.parquet(f"{folder}/t").count() == 0
