import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegate.functions import decode, effective_change_time, format_watermark, with_suffix
from tidegate.operators import filters
from tidegate.plans.database import suffix_governed


def test_watermark_is_strict_to_the_microsecond(spark):
    last = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(last,), (last + dt.timedelta(microseconds=1),)], "t timestamp")
    for kind in ("timestamp", "timestamp_ntz"):
        kept = filters.after_watermark(df.select(F.col("t").cast(kind)), "T", last).collect()
        assert [r.t for r in kept] == [last + dt.timedelta(microseconds=1)]
    text = df.select(format_watermark("t").alias("t"))
    assert filters.after_watermark(text, "t", "2024-01-01 12:00:00").count() == 1


def test_watermark_edge_cases(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp")
    assert filters.after_watermark(df, "t", " ").count() == 1
    assert filters.after_watermark(df, "t", None).count() == 1
    with pytest.raises(ValueError):
        filters.after_watermark(df, " ", "2024-01-01")


def test_watermark_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = filters.after_watermark(events, "ts", dt.datetime(2024, 1, 15))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-01-15" in plan


def test_history_window_and_bounds(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 31),), (dt.date(2020, 2, 1),), (None,)], "d date")
    as_of = dt.date(2024, 2, 1)
    assert [r.d for r in filters.history_window(df, "d", as_of).collect()] == [dt.date(2020, 2, 1)]
    assert filters.history_window(df, "d", as_of, None).count() == 3
    assert filters.between_bounds(df, "d", None, "2020-02-01").count() == 1
    assert filters.between_bounds(df, "d", "2020-02-01").count() == 1
    ids = spark.range(10)
    assert [r.id for r in filters.between_bounds(ids, "id", 3, 5).collect()] == [3, 4]


def test_soft_delete_without_the_column(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, Is_Deleted boolean")
    assert sorted(r.k for r in filters.not_soft_deleted(df).collect()) == [2, 3]
    assert filters.not_soft_deleted(df.drop("Is_Deleted")).count() == 3


def test_preview(spark):
    df = spark.range(200)
    assert filters.preview(df, None).count() == 200
    assert filters.preview(df, "", when_unset=100).count() == 100
    assert filters.preview(df, "7").count() == 7
    assert filters.preview(df, 0) is None


@pytest.mark.parametrize("extra", [0, 2000])
def test_suffix(spark, extra):
    df = spark.createDataFrame([(1, "X"), (1, "X-D"), (1, None), (2, "Y"), (None, "Z")], "RouteId int, RouteCode string")
    governed = [1] + list(range(10, 10 + extra))
    once = suffix_governed(df, ("RouteId", "RouteCode"), governed)
    twice = suffix_governed(once, ("RouteId", "RouteCode"), governed)
    expected = sorted([(1, "X-D"), (1, "X-D"), (1, ""), (2, "Y"), (0, "Z")])
    for result in (once, twice):
        assert sorted((r.RouteId or 0, r.RouteCode or "") for r in result.collect()) == expected
    assert suffix_governed(df, ("routeid", "RouteCode"), [1]) is df
    assert suffix_governed(df, ("RouteId", "RouteCode"), []) is df


def test_column_functions(spark):
    df = spark.createDataFrame([("100", 1), ("700", None), ("999", 1), ("x", 1), (None, 1)], "code string, u int")
    names = [r[0] for r in df.select(decode("code", {100: "SentToCAPs", 700: "SentForPayroll"})).collect()]
    assert names == ["SentToCAPs", "SentForPayroll", "999", "x", None]
    assert [r[0] for r in df.select(effective_change_time("u", F.lit(5))).collect()] == [1, 5, 1, 1, 1]
    assert df.select(with_suffix(F.lit("a"), F.lit(True), "!")).first()[0] == "a!"
