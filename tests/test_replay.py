"""Loads that die at any step and are run again; readers in the middle of a merge; tables and ledgers that grow."""

import datetime as dt

import pytest

from tidegate.plans import lake
from tidegate.plans.specs import LakeEntity
from tidegate.sinks import ledger, tables
from tidegate.workspace import exists, release, write_text

AS_OF = dt.datetime(2024, 2, 1)
SCHEMA = "k int, v string, UpdatedDateTime timestamp, CreatedDateTime timestamp"


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def source(spark, *rows):
    return spark.createDataFrame([(k, v, at(m), at(0)) for k, v, m in rows], SCHEMA)


FIRST = [(1, "a", 1), (2, "b", 2)]
SECOND = [*FIRST, (2, "B", 5), (3, "c", 6)]
THIRD = [*SECOND, (4, "d", 8)]


def content(df):
    return sorted((r.k, r.v) for r in df.collect())


class Died(Exception):
    pass


def dies(monkeypatch, owner, name, after):
    """Let a function end the run at its call number ``after``; returns what undoes it."""
    real, calls = getattr(owner, name), []

    def dying(*args, **kwargs):
        if len(calls) == after:
            raise Died
        calls.append(name)
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, dying)
    return lambda: monkeypatch.setattr(owner, name, real)


STEPS = [
    (lake, "put_batch", 0),
    (tables, "rename", 0),
    (lake, "replicate", 0),
    (lake, "merge_into", 0),
    (lake, "grow_buckets", 0),
    (ledger, "append", 0),
    (ledger, "_log", 0),
    (ledger, "_write_head", 1),
]


@pytest.mark.parametrize(("owner", "name", "after"), STEPS)
@pytest.mark.parametrize("first_dies", [False, True])
def test_a_load_that_dies_is_repeated(spark, folder, monkeypatch, owner, name, after, first_dies):
    spec = LakeEntity(
        "T", ["k"], f"{folder}/raw", f"{folder}/cur", watermark="UpdatedDateTime", buckets=4, incremental=True, raw_replica=f"{folder}/raw2"
    )
    run = lambda rows: lake.load(spark, spec, source(spark, *rows), "transactional", f"{folder}/ledger", AS_OF)
    for rows, dying in ((FIRST, first_dies), (SECOND, True), (THIRD, False)):
        if dying:
            undo = dies(monkeypatch, owner, name, after)
            try:
                run(rows)
            except Died:
                pass
            undo()
        run(rows)
        raw, replica = (tables.read_bucketed(spark, p) for p in (spec.raw_path, spec.raw_replica))
        assert tables.same_content(raw, replica)
    assert content(raw) == [(1, "a"), (2, "B"), (2, "b"), (3, "c"), (4, "d")]
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert ledger.read(spark, f"{folder}/ledger").count() == 3
    assert ledger.last_watermark(spark, f"{folder}/ledger", "T") == at(8)


def test_daily_appends_are_repeated_too(spark, folder, monkeypatch):
    spec = LakeEntity(
        "T", ["k"], f"{folder}/raw", f"{folder}/cur", watermark="UpdatedDateTime", buckets=4, incremental=True, grain="DAILY", append_daily=True
    )
    run = lambda rows: lake.load(spark, spec, source(spark, *rows), "transactional", f"{folder}/ledger", AS_OF)
    for rows in (FIRST, SECOND):
        undo = dies(monkeypatch, ledger, "append", 0)
        with pytest.raises(Died):
            run(rows)
        undo()
        run(rows)
    assert content(lake.current_state(spark, spec)) == [(1, "a"), (2, "B"), (2, "b"), (3, "c")]
    assert tables.held_buckets(spark, spec.current_path) == 4


def test_rows_from_before_batches_become_one(spark, folder):
    path, copy = f"{folder}/t", f"{folder}/copy"
    plain = source(spark, *FIRST)
    tables.write_table(plain, path, "overwrite")
    tables.replicate(spark, path, copy)
    tables.put_batch(spark, source(spark, (9, "z", 9)), path, at(2))
    assert content(tables.read_bucketed(spark, path)) == [(1, "a"), (2, "b"), (9, "z")]
    assert content(tables.settled_rows(spark, path)) == [(1, "a"), (2, "b")]
    tables.replicate(spark, path, copy)
    assert tables.same_content(tables.read_bucketed(spark, path), tables.read_bucketed(spark, copy))
    names = tables.batches(spark, copy)
    tables.put_batch(spark, source(spark, (9, "Z", 9)), path, at(2))
    assert tables.sync_batches(spark, path, copy) == [tables.batches(spark, path)[-1]]
    assert tables.batches(spark, copy)[0] == names[0] and tables.batches(spark, copy) == tables.batches(spark, path)
    assert tables.sync_batches(spark, path, copy) == []
    with pytest.raises(ValueError, match="extra"):
        tables.put_batch(spark, plain.selectExpr("*", "1 AS extra"), path, at(5))


@pytest.mark.parametrize("step", [1, 2])
def test_an_adoption_that_dies_is_finished(spark, folder, monkeypatch, step):
    path = f"{folder}/t"
    tables.write_table(source(spark, *FIRST), path, "overwrite")
    undo = dies(monkeypatch, tables, "rename", step - 1)
    with pytest.raises(Died):
        tables.put_batch(spark, source(spark, (9, "z", 9)), path, at(2))
    undo()
    tables.put_batch(spark, source(spark, (9, "z", 9)), path, at(2))
    assert content(tables.read_bucketed(spark, path)) == [(1, "a"), (2, "b"), (9, "z")]


@pytest.mark.parametrize("renames", [0, 1, 2, 5])
def test_a_reader_never_sees_half_a_merge(spark, folder, monkeypatch, renames):
    path, schema = f"{folder}/t", "id int, v string"
    old = {i: "old" for i in range(40)}
    tables.write_bucketed(spark.createDataFrame(list(old.items()), schema), path, ["id"], 8)
    undo = dies(monkeypatch, tables, "rename", renames)
    with pytest.raises(Died):
        tables.merge_into(spark, path, spark.createDataFrame([(i, "new") for i in range(60)], schema), ["id"])
    undo()
    with pytest.raises(RuntimeError, match="swapped"):
        tables.read_bucketed(spark, path)
    tables.restore_table(spark, path)
    assert {r.id: r.v for r in tables.read_bucketed(spark, path).collect()} == {i: "new" for i in range(60)}


def test_a_swap_while_files_are_listed_is_noticed(spark, folder, monkeypatch):
    path, schema = f"{folder}/t", "id int, v string"
    tables.write_bucketed(spark.createDataFrame([(i, "old") for i in range(40)], schema), path, ["id"], 8)
    real, calls = tables._swaps, []

    def swaps(session, where):
        calls.append(where)
        if len(calls) == 2:
            monkeypatch.setattr(tables, "_swaps", real)
            tables.merge_into(spark, path, spark.createDataFrame([(i, "new") for i in range(40)], schema), ["id"])
        return real(session, where)

    monkeypatch.setattr(tables, "_swaps", swaps)
    assert {r.v for r in tables.read_bucketed(spark, path).collect()} == {"new"}


def test_buckets_grow_with_the_table(spark, folder):
    path, schema = f"{folder}/t", "id bigint, v string"
    rows = lambda low, high: spark.range(low, high).selectExpr("id", "sha2(CAST(id AS STRING), 512) AS v")
    tables.write_bucketed(rows(0, 2000), path, ["id"], 4)
    target, bounds = tables.table_bytes(spark, path) // 3, [2000 + 1500 * k for k in range(21)]
    for low, high in zip(bounds, bounds[1:], strict=False):
        tables.merge_into(spark, path, rows(low, high), ["id"])
        tables.grow_buckets(spark, path, ["id"], target)
    assert tables.held_buckets(spark, path) == 64
    stored = spark.read.parquet(path)
    assert stored.where(stored[tables.BUCKET] != tables.key_bucket(["id"], 64)).count() == 0
    assert stored.select("id").distinct().count() == stored.count() == bounds[-1]
    before = set(stored.inputFiles())
    touched = tables.merge_into(spark, path, spark.createDataFrame([(5, "new")], schema), ["id"])
    assert len(touched) == 1
    assert len(before - set(spark.read.parquet(path).inputFiles())) <= 2
    assert tables.grow_buckets(spark, path, ["id"], target) == 64


def test_a_split_reaches_the_replica_and_the_first_write(spark, folder):
    path, copy = f"{folder}/t", f"{folder}/copy"
    rows = spark.range(5000).selectExpr("id", "sha2(CAST(id AS STRING), 512) AS v")
    tables.replace_bucketed(spark, rows, path, ["id"], 4, bucket_bytes=20_000)
    grown = tables.held_buckets(spark, path)
    assert grown > 4 and exists(spark, path) and not exists(spark, f"{path}__split")
    tables.replicate(spark, path, copy)
    tables.grow_buckets(spark, path, ["id"], 5_000)
    assert tables.held_buckets(spark, path) > grown
    touched = tables.merge_into(spark, path, rows.where("id < 3"), ["id"])
    tables.replicate(spark, path, copy, touched)
    assert tables.held_buckets(spark, copy) == tables.held_buckets(spark, path)
    assert tables.same_content(spark.read.parquet(path), spark.read.parquet(copy))


# Ledger


def test_a_long_log_costs_a_load_one_file(spark, folder):
    path = f"{folder}/ledger"
    rows = spark.range(10_000).selectExpr(
        "concat('n', id % 50) AS TABLE_NAME", "timestamp'2024-01-01' AS LOAD_DATE", "'Y' AS LOAD_COMPLETE_FLAG", "id AS ROW_COUNT",
        "timestamp_micros(id * 1000000) AS LAST_LOAD_TIMESTAMP",
    )
    rows.repartition(300).write.parquet(path)
    assert ledger.last_watermark(spark, path, "n7") == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=9957)
    ledger.append(spark, path, "n7", 1, at(1), AS_OF)
    assert len(ledger._log_files(spark, path)) == 1
    assert ledger.read(spark, path).count() == 10_001
    release(spark, path)
    assert ledger.last_watermark(spark, path, "n7") == at(1)
    ledger.forget_head(spark, path, "n7")
    assert ledger.last_watermark(spark, path, "n7") == ledger.EPOCH


@pytest.mark.parametrize("step", ["rename", "release"])
def test_a_fold_that_dies_is_finished(spark, folder, monkeypatch, step):
    path = f"{folder}/ledger"
    for minute in range(4):
        ledger.append(spark, path, "a", 1, at(minute), AS_OF)
    undo = dies(monkeypatch, ledger, step, 0)
    with pytest.raises(Died):
        ledger.fold(spark, path)
    undo()
    assert ledger.read(spark, path).count() == 4
    assert len(ledger._log_files(spark, path)) == 1


def test_another_fold_is_left_alone(spark, folder):
    path = f"{folder}/ledger"
    ledger.append(spark, path, "a", 1, at(0), AS_OF)
    write_text(spark, f"{path}__fold/rows", "under way")
    assert not ledger.fold(spark, path)
    assert ledger.read(spark, path).count() == 1


@pytest.mark.parametrize(("step", "after"), [("_log", 0), ("_write_head", 1)])
def test_a_stream_batch_is_recorded_once(spark, folder, monkeypatch, step, after):
    path = f"{folder}/ledger"
    add = lambda number: ledger.append(spark, path, f"s#{number}", 1, at(number), AS_OF, stream="s", batch=number)
    add(0)
    undo = dies(monkeypatch, ledger, step, after)
    with pytest.raises(Died):
        add(1)
    undo()
    add(1)
    assert not add(0)
    assert sorted(r.TABLE_NAME for r in ledger.read(spark, path).collect()) == ["s#0", "s#1"]
