import random

import pytest

from tidegate.operators import merge


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def content(df):
    return sorted(((r.k if r.k is not None else -1), r.v) for r in df.collect())


def test_upsert(spark):
    base, updates = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "B"), (3, "C")])
    once = merge.upsert(base, updates, ["K"])
    assert content(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert content(merge.upsert(once, updates, ["k"])) == content(once)


@pytest.mark.parametrize("unique", [True, False])
def test_upsert_null_keys_never_match(spark, unique):
    base, updates = frame(spark, [(None, "a"), (1, "b")]), frame(spark, [(None, "x"), (None, "y"), (1, "B")])
    result = merge.upsert(base, updates, ["k"], base_is_unique=unique)
    assert content(result) == [(-1, "a"), (-1, "x"), (-1, "y"), (1, "B")]


@pytest.mark.parametrize("unique", [True, False])
def test_upsert_refuses_repeated_update_keys(spark, unique):
    base, updates = frame(spark, [(1, "a")]), frame(spark, [(2, "B"), (2, "C")])
    with pytest.raises(Exception, match="duplicate merge key"):
        merge.upsert(base, updates, ["k"], base_is_unique=unique).collect()


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("unique", [True, False])
def test_repeated_keys_are_refused_whatever_the_base_holds(spark, conf, unique, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    updates = frame(spark, [(2, "B"), (2, "C"), (None, "n"), (None, "n")])
    for base in (frame(spark, []), frame(spark, [(1, "a")]), frame(spark, [(2, "a")])):
        with pytest.raises(Exception, match="duplicate merge key"):
            merge.upsert(base, updates, ["k"], base_is_unique=unique).collect()
        with pytest.raises(Exception, match="duplicate merge key"):
            merge.update_columns(base, updates, ["k"], ["v"]).collect()
        with pytest.raises(Exception, match="duplicate merge key"):
            merge.update_columns(updates, base, ["k"], ["v"]).collect()


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_merge_into_refuses_repeated_keys_before_it_writes(spark, conf, folder, threshold):
    from tidegate.sinks import tables

    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    tables.write_bucketed(frame(spark, [(7, "a")]), folder, ["k"], 64)
    with pytest.raises(ValueError, match="duplicate merge key"):
        tables.merge_into(spark, folder, frame(spark, [(1, "x"), (1, "y")]), ["k"], 64)
    assert content(spark.read.parquet(folder)) == [(7, "a")]


def test_upsert_updates_every_row_of_a_repeated_base_key(spark):
    base, updates = frame(spark, [(1, "a"), (1, "b"), (2, "c")]), frame(spark, [(1, None), (3, "d")])
    result = merge.upsert(base, updates, ["k"], base_is_unique=False)
    assert sorted(((r.k, r.v or "") for r in result.collect())) == [(1, ""), (1, ""), (2, "c"), (3, "d")]


def test_insert_absent(spark):
    base, batch = frame(spark, [(1, "a")]), frame(spark, [(1, "A"), (2, "x"), (2, "y")])
    once = merge.insert_absent(base, batch, ["k"])
    assert content(once) == [(1, "a"), (2, "y")]
    assert content(merge.insert_absent(once, batch, ["k"])) == content(once)


def test_update_columns(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 0)], "k int, v string, n int")
    updates = spark.createDataFrame([(1, "A", 10), (3, "C", 30), (None, "N", 5)], "k int, v string, n int")
    result = merge.update_columns(base, updates, ["k"], ["N"])
    rows = sorted((r.k or 0, r.v, r.n) for r in result.collect())
    assert rows == [(0, "N", 5), (0, "n", 0), (1, "a", 10), (2, "b", 2), (3, "C", 30)]
    nulls = spark.createDataFrame([(1, "A", None)], "k int, v string, n int")
    assert merge.update_columns(base, nulls, ["k"], ["n"]).where("k = 1").first().n is None


def test_any_split_of_a_feed_gives_the_same_state(spark):
    rng = random.Random(3)
    feed = [(rng.randrange(8), rng.randrange(30), i) for i in range(80)]
    schema = "k int, t int, i int"
    whole = spark.createDataFrame(feed, schema)
    expected = sorted(merge.merge_latest(whole.limit(0), whole, ["k"], ["t"]).collect())
    for parts in (2, 5):
        rng.shuffle(feed)
        state = whole.limit(0)
        for p in range(parts):
            state = merge.merge_latest(state, spark.createDataFrame(feed[p::parts], schema), ["k"], ["t"])
        assert sorted(state.collect()) == expected


def test_updates_take_the_types_of_the_base(spark, folder):
    from tidegate.sinks import tables

    base = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    updates = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    expected = [(1, "a"), (2, "B"), (3, "C")]
    for unique in (True, False):
        assert content(merge.upsert(base, updates, ["k"], base_is_unique=unique)) == expected
    assert content(merge.insert_absent(base, updates, ["k"])) == [(1, "a"), (2, "b"), (3, "C")]
    assert content(merge.update_columns(base, updates, ["k"], ["v"])) == expected
    tables.write_bucketed(base, folder, ["k"], 8)
    tables.merge_into(spark, folder, updates, ["k"], 8)
    stored = spark.read.parquet(folder)
    assert content(stored) == expected
    assert stored.where(stored[tables.BUCKET] != tables.key_bucket(["k"], 8)).count() == 0
