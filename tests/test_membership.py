import pytest
from pyspark.sql import functions as F

from tidegate.operators.membership import (
    exclude_keys,
    filter_by_ids,
    filter_by_relation,
    include_keys,
)


@pytest.fixture
def keyed(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")


def values(df):
    return sorted(r.v for r in df.collect())


@pytest.mark.parametrize("extra", [0, 1500])
def test_id_list(keyed, extra):
    ids = [1] + list(range(100, 100 + extra))
    assert values(filter_by_ids(keyed, "K", ids, "include")) == ["a"]
    assert values(filter_by_ids(keyed, "K", ids, "exclude")) == ["b"]


def test_empty_id_list(keyed):
    assert values(filter_by_ids(keyed, "k", [], "include")) == []
    assert values(filter_by_ids(keyed, "k", [], "exclude")) == ["a", "b", "c"]


def test_text_ids_are_not_trimmed(keyed):
    assert values(filter_by_ids(keyed, "v", [" a", "b", "o'b"])) == ["b"]
    assert values(filter_by_ids(keyed, "v", ["b"] + [f"x{i}" for i in range(1200)])) == ["b"]


def test_relation(spark, keyed):
    other = spark.createDataFrame([(1,), (1,), (None,)], "ID int")
    assert values(filter_by_relation(keyed, "k", other, "id", "include")) == ["a"]
    assert values(filter_by_relation(keyed, "k", other, "id", "exclude")) == ["b", "c"]
    with pytest.raises(ValueError, match="mode"):
        filter_by_relation(keyed, "k", other, "id", "only")
    with pytest.raises(ValueError, match="not found"):
        filter_by_relation(keyed, "k", other, "nope")


def test_composite_keys(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, None, "b"), (2, 2, "c")], "x int, y int, v string")
    members = spark.createDataFrame([(1, 1), (1, None), (9, 9)], "x int, y int")
    assert values(include_keys(df, members, ["x", "y"])) == ["a"]
    assert values(exclude_keys(df, members, ["x", "y"])) == ["b", "c"]
    assert values(exclude_keys(df, members, ["x", "y"], drop_nulls=True)) == ["c"]


def test_short_list_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = filter_by_ids(df, "o_custkey", [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_custkey, [1,2])]" in plan


@pytest.mark.parametrize("kind", ["int", "bigint", "smallint", "decimal(38,0)", "decimal(10,2)", "double"])
@pytest.mark.parametrize("other", ["int", "bigint", "decimal(38,0)", "decimal(10,2)", "double"])
def test_key_types_may_differ(spark, kind, other):
    df = spark.sql(f"SELECT CAST(k AS {kind}) AS k, v FROM VALUES (1, 'a'), (2, 'b'), (NULL, 'c') AS t(k, v)")
    members = spark.sql(f"SELECT CAST(k AS {other}) AS k FROM VALUES (1), (1), (7) AS t(k)")
    assert values(include_keys(df, members, ["k"])) == ["a"]
    assert values(exclude_keys(df, members, ["k"])) == ["b", "c"]
    assert values(exclude_keys(df, members.distinct(), ["k"], unique=True)) == ["b", "c"]


LENGTHS = [1, 2, 1000, 1001, 5000]


@pytest.mark.parametrize("length", LENGTHS)
@pytest.mark.parametrize("kind", ["int", "bigint", "decimal(12,2)", "string"])
@pytest.mark.parametrize("as_frame", [False, True])
def test_a_list_means_the_same_at_any_length(spark, length, kind, as_frame):
    ids = [3, *range(3_000_000_000, 3_000_000_000 + length - 1)]
    rows = [(1, "3"), (2, "4"), (3, None), (4, "03"), (5, "A7"), (6, " 3"), (7, "3.00"), (8, "3.5")]
    df = spark.createDataFrame(rows, "n int, t string").select("n", F.col("t").try_cast(kind).alias("k"))
    given = spark.createDataFrame([(i,) for i in ids], "i bigint") if as_frame else ids
    inside = sorted(r.n for r in filter_by_ids(df, "k", given).collect())
    outside = sorted(r.n for r in filter_by_ids(df, "k", given, "exclude").collect())
    held = {r.n for r in df.where("k IS NOT NULL").collect()}
    whole = {"int": {1, 4, 6, 7, 8}, "bigint": {1, 4, 6, 7, 8}, "decimal(12,2)": {1, 4, 6, 7}, "string": {1, 4, 6, 7}}[kind]
    whole &= {r.n for r in df.where("try_cast(k AS double) = 3").collect()}
    assert set(inside) == whole
    assert set(outside) == held - whole


@pytest.mark.parametrize("length", LENGTHS)
def test_text_lists_mean_the_same_at_any_length(spark, length):
    ids = ["3", *[f"x{i}" for i in range(length - 1)]]
    text = spark.createDataFrame([("3",), ("03",), ("A7",), (None,)], "k string")
    assert [r.k for r in filter_by_ids(text, "k", ids).collect()] == ["3"]
    assert sorted(r.k for r in filter_by_ids(text, "k", ids, "exclude").collect()) == ["03", "A7"]
    numbers = spark.createDataFrame([(3,), (4,), (None,)], "k int")
    assert [r.k for r in filter_by_ids(numbers, "k", ids).collect()] == [3]
    assert [r.k for r in filter_by_ids(numbers, "k", ids, "exclude").collect()] == [4]


def test_an_empty_frame_of_ids(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    empty = spark.createDataFrame([], "i int")
    assert filter_by_ids(df, "k", empty).count() == 0
    assert filter_by_ids(df, "k", empty, "exclude").count() == 2
