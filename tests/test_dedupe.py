import datetime as dt
import random

import pytest

from tidegate.operators.dedupe import dedupe_latest, distinct_keys, union_distinct
from tidegate.operators.names import exclude_columns, resolve

D = dt.datetime


def test_null_order_value_loses(spark):
    df = spark.createDataFrame(
        [("A", None, D(2024, 1, 2)), ("A", D(2024, 1, 1), D(2024, 1, 1))], "k string, UpdatedDateTime timestamp, CreatedDateTime timestamp"
    )
    row = dedupe_latest(df, ["k"], ["UpdatedDateTime", "CreatedDateTime"]).collect()
    assert [r.UpdatedDateTime for r in row] == [D(2024, 1, 1)]


def test_ties_do_not_depend_on_input_order(spark):
    rows = [("A", 1, f"p{i}") for i in range(50)]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v int, payload string").repartition(seed + 1)
        found.add(dedupe_latest(df, ["K"], ["v"]).first().payload)
    assert found == {"p9"}


def test_null_keys_are_one_group_and_no_keys_is_identity(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 1)], "k int, v int")
    assert sorted((r.k or 0, r.v) for r in dedupe_latest(df, ["k"], ["v"]).collect()) == [(0, 2), (1, 1)]
    assert dedupe_latest(df, []).count() == 3


def test_idempotent_and_one_row_per_key(spark):
    rng = random.Random(7)
    df = spark.createDataFrame([(rng.randrange(20), rng.randrange(5), rng.random()) for _ in range(300)], "k int, o int, v double")
    once = dedupe_latest(df, ["k"], ["o"])
    assert once.count() == df.select("k").distinct().count()
    assert sorted(dedupe_latest(once, ["k"], ["o"]).collect()) == sorted(once.collect())
    best = {}
    for r in df.collect():
        best[r.k] = max(best.get(r.k, (-1, -1.0)), (r.o, r.v))
    assert {r.k: (r.o, r.v) for r in once.collect()} == best


def test_map_columns_are_carried(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS v, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2)")
    assert dedupe_latest(df, ["k"], ["v"]).first().m == {"b": 2}


def test_distinct_and_union(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([("w", 2), ("v", 3)], "v string, k int")
    assert sorted(r.k for r in distinct_keys(a, ["K"]).collect()) == [1, 2]
    assert sorted((r.k or 0, r.v) for r in union_distinct(a, b, ["k"]).collect()) == [(0, "z"), (1, "x"), (2, "y"), (3, "v")]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert resolve(df, [" a", "B "]) == ["A", "b"]
    assert exclude_columns(df, ["a"]).columns == ["b"]
    with pytest.raises(ValueError, match="not found"):
        exclude_columns(df, ["c"])
