"""Hot and NULL keys: no task may hold a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from tidegate.operators.dedupe import dedupe_latest
from tidegate.operators.hierarchy import descendants
from tidegate.operators.membership import exclude_keys, include_keys
from tidegate.workspace import stage


@pytest.fixture
def no_broadcast(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100000",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50000",
        spark__sql__shuffle__partitions="32",
    )


@pytest.fixture
def hot(spark):
    """A third of the rows have the key 7 and another seventh have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id"))
    return spark.range(200_000, numPartitions=16).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("p"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("join", [include_keys, exclude_keys])
def test_hot_partition_is_split(spark, hot, no_broadcast, join):
    members = spark.range(100_000).select((F.col("id") * 2 + 1).alias("k"))
    result = join(hot, members, ["k"])
    rows = result.collect()
    assert "SortMergeJoin(skew=true)" in plan(result)
    held = {r.k for r in members.collect()}
    expected = [r for r in hot.collect() if (r.k in held) == (join is include_keys)]
    assert len(rows) == len(expected)


def test_null_keys_are_spread(spark, no_broadcast, conf):
    conf(spark__sql__adaptive__enabled="false")
    df = spark.range(100_000, numPartitions=8).select(F.when(F.col("id") < 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    kept = exclude_keys(df, spark.range(10).withColumnRenamed("id", "k"), ["k"])
    sizes = kept.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 100_000
    assert max(r["count"] for r in sizes) < 10_000


def test_dedupe_reduces_before_the_shuffle(spark, hot):
    text = plan(dedupe_latest(hot, ["k"], ["p"]))
    assert text.index("Exchange hashpartitioning(k") < text.index("partial_max")


def test_hot_parent(spark, no_broadcast):
    nodes = spark.range(60_000).select(F.col("id"), F.when(F.col("id") < 20_000, 59_999).otherwise(F.col("id") - 10_000).alias("parent"))
    seeds = spark.createDataFrame([(59_999,)], "id bigint")
    assert descendants(nodes, seeds, "id", "parent").count() == 60_000


def test_stage_reports_what_it_wrote(spark):
    staged = stage(spark.range(10), "x", F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    assert staged.metrics == {"n": 10, "m": 9} and staged.df.count() == 10
    empty = stage(spark.range(10).where("id > 50"), "x", F.count(F.lit(1)).alias("n"))
    assert empty.metrics == {"n": 0} and empty.df.columns == ["id"]


def test_no_cut_of_lineage_by_local_copies():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "tidegate"
    text = "".join(p.read_text() for p in root.rglob("*.py"))
    for word in ("localCheckpoint", "crossJoin", "toPandas("):
        assert word not in text
