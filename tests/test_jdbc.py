"""JDBC sources, sinks and loads on an in-memory database of this JVM."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegate.plans import database as plan
from tidegate.plans.specs import DatabaseEntity
from tidegate.sinks import jdbc as sink
from tidegate.sinks import ledger
from tidegate.sinks.reach import Reach, reach_of
from tidegate.sinks.targets import JdbcTarget, append_absent, write_chunks
from tidegate.sources import jdbc as source

AS_OF = dt.datetime(2024, 2, 1)


@pytest.fixture
def customers(spark):
    return spark.read.parquet("/root/testdata/sf0.001/customer.parquet")


@pytest.fixture
def loaded(customers, database):
    sink.write(customers, database, "customer")
    return database


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_round_trip(spark, customers, loaded):
    assert rows(source.scan(spark, loaded, "SELECT * FROM customer;")) == rows(customers)


def test_filter_reaches_the_source(spark, loaded):
    df = source.scan(spark, loaded, "SELECT * FROM customer").where("c_nationkey = 3")
    assert "PushedFilters: [*IsNotNull(c_nationkey), *EqualTo(c_nationkey,3)]" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("tasks", [1, 4])
def test_partitioned_scan(spark, customers, loaded, tasks):
    df = source.partitioned_scan(spark, loaded, "SELECT * FROM customer", '"c_custkey"', tasks)
    assert df.rdd.getNumPartitions() == tasks and rows(df) == rows(customers)
    empty = source.partitioned_scan(spark, loaded, 'SELECT * FROM customer WHERE "c_custkey" < 0', '"c_custkey"', tasks)
    assert empty.count() == 0


def test_predicate_and_key_scans(spark, customers, loaded):
    parts = ['"c_nationkey" < 9', '"c_nationkey" >= 9']
    df = source.predicate_scan(spark, loaded, "SELECT * FROM customer", parts)
    assert df.rdd.getNumPartitions() == 2 and rows(df) == rows(customers)
    expected = rows(customers.select("c_nationkey").distinct())
    keys = ['"c_nationkey"']
    assert rows(source.key_scan(spark, loaded, "SELECT * FROM customer", keys)) == expected
    assert rows(source.key_scan(spark, loaded, "SELECT * FROM customer", keys, parts)) == expected


def test_existing_keys_by_predicates(spark, customers, loaded):
    parts = ('MOD("c_custkey", 2) = 0', 'MOD("c_custkey", 2) = 1')
    held = JdbcTarget(loaded, parts).held_keys(spark, "customer", ['"c_custkey"'])
    assert sorted(r[0] for r in held.collect()) == sorted(r[0] for r in customers.select("c_custkey").distinct().collect())


def test_decimal_bounds_are_whole_numbers(spark, loaded):
    query = 'SELECT CAST("c_acctbal" AS DECIMAL(12,2)) AS A FROM customer'
    assert source.partitioned_scan(spark, loaded, query, "A", 3).count() == source.row_count(source.scan(spark, loaded, query))


@pytest.mark.parametrize("kind", ["BIGINT", "DECIMAL(20,2)", "DOUBLE", "DATE", "TIMESTAMP"])
def test_balanced_scan(spark, database, kind):
    skewed = spark.range(4000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN NULL WHEN id < 3600 THEN id ELSE id * id END AS n")
    value = {"DATE": "date_add(date'2000-01-01', CAST(n % 20000 AS INT))", "TIMESTAMP": "timestamp_seconds(n)"}.get(kind, f"CAST(n AS {kind})")
    rows_in = skewed.selectExpr("id", f"{value} AS c")
    sink.write(rows_in, database, "skewed")
    df = source.balanced_scan(spark, database, "SELECT * FROM skewed", '"c"', 8)
    assert rows(df) == rows(rows_in)
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert 7 <= len(sizes) <= 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_balanced_scan_edges(spark, database):
    sink.write(spark.createDataFrame([(None,), (5,), (5,), (5,)], "c int"), database, "fews")
    df = source.balanced_scan(spark, database, "SELECT * FROM fews", '"c"', 4)
    assert rows(df.where("c IS NOT NULL")) == [(5,)] * 3 and df.count() == 4
    sink.write(spark.createDataFrame([(None,)], "c int"), database, "empties")
    assert source.balanced_scan(spark, database, "SELECT * FROM empties", '"c"', 4).count() == 1


def rows_read(spark, run):
    """What ``run`` gives, and the rows that JDBC and file scans read meanwhile."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    result = run()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    total = 0
    executions = store.executionsList()
    for k in range(before, executions.size()):
        execution = executions.apply(k)
        values = store.executionMetrics(execution.executionId())
        nodes = store.planGraph(execution.executionId()).allNodes()
        for n in range(nodes.size()):
            node = nodes.apply(n)
            if node.name().startswith("Scan JDBC"):
                for m in range(node.metrics().size()):
                    metric = node.metrics().apply(m)
                    if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                        total += int(values.apply(metric.accumulatorId()).replace(",", ""))
    return result, total


@pytest.mark.parametrize("kind", ["BIGINT", "STRING"])
def test_a_small_batch_reads_few_keys(spark, database, kind):
    held = spark.range(100_000).selectExpr(f"CAST(id AS {kind}) AS K", "id AS V")
    sink.write(held, database, "big", options={"createTableColumnTypes": "K VARCHAR(20)"} if kind == "STRING" else {})
    batch = spark.range(99_950, 100_050).selectExpr(f"CAST(id AS {kind}) AS K", "id AS V")
    added, read = rows_read(spark, lambda: append_absent(batch, JdbcTarget(database), "big", ["k"]))
    assert added == 50
    assert 0 < read < 10_000
    total = source.scan(spark, database, "SELECT * FROM big").where("K IS NOT NULL")
    assert total.count() == 100_050


def test_a_large_batch_reads_ranges(spark, database):
    held = spark.range(20_000).selectExpr("id AS K")
    sink.write(held, database, "ranges")
    batch = spark.range(3_000).selectExpr("CASE WHEN id < 1500 THEN id ELSE id + 18000 END AS K")
    reach = reach_of(batch, "K")
    assert reach.values is None and len(reach.ranges) == 16
    assert sum(high - low + 1 for low, high in reach.ranges) < 4_500
    added, read = rows_read(spark, lambda: append_absent(batch, JdbcTarget(database), "ranges", ["K"]))
    assert added == 1_000
    assert 0 < read < 5_000


def test_reach_of_any_batch(spark):
    some = spark.createDataFrame([("o'b", 1.5), (None, None)], "t string, d double")
    assert reach_of(some, "t").predicates('"t"') == ["\"t\" IN ('o''b')"]
    assert reach_of(some, "d") == Reach()
    assert reach_of(some.limit(0), "t").predicates("t") == ["1 = 0"]
    assert reach_of(spark.range(2_000).selectExpr("CAST(id AS STRING) AS t"), "t").predicates("t") == []


def test_truncate_insert(spark, customers, loaded):
    sink.write(customers.limit(3), loaded, "customer", "truncate_insert")
    assert source.scan(spark, loaded, "SELECT * FROM customer").count() == 3
    with pytest.raises(ValueError, match="mode"):
        sink.write(customers, loaded, "customer", "replace")


def test_chunks(spark, customers, database):
    target = JdbcTarget(database)
    for _ in range(2):
        assert write_chunks(customers, target, "customer", "C_CUSTKEY", 3, "truncate_insert", 150) == 3
    assert rows(source.scan(spark, database, "SELECT * FROM customer")) == rows(customers)
    with pytest.raises(ValueError, match="not found"):
        write_chunks(customers, target, "customer", "nope", 3)


def test_append_absent(spark, customers, database):
    target = JdbcTarget(database)
    first = customers.where("c_custkey < 50").toDF(*[c.upper() for c in customers.columns])
    sink.write(first, database, "customer")
    everything = customers.toDF(*first.columns).unionByName(first)
    assert append_absent(everything, target, "customer", ["c_custkey"]) == customers.count() - 50
    assert append_absent(everything, target, "customer", ["c_custkey"]) == 0
    assert rows(source.scan(spark, database, "SELECT * FROM customer")) == rows(customers)


def entity(**changes):
    settings = dict(name="Customer", table="stg_Customer", write_mode="append", dedupe_keys=["ID"], watermark="SEEN", incremental=True, write_enabled=True)
    return DatabaseEntity(**settings | changes)


def changes(spark, *rows):
    return spark.createDataFrame([(k, v, dt.datetime(2024, 1, d)) for k, v, d in rows], "ID int, V string, SEEN timestamp")


def test_transactional_load(spark, database, folder):
    target, path = JdbcTarget(database), f"{folder}/ledger"
    sink.write(changes(spark, (1, "held", 1)), database, "stg_Customer")
    first = plan.load(spark, entity(), changes(spark, (1, "x", 1), (2, "b", 2)), target, "transactional", path, AS_OF)
    assert (first.status, first.row_count, first.watermark) == ("written", 1, dt.datetime(2024, 1, 2))
    second = plan.load(spark, entity(), changes(spark, (2, "b", 2), (3, "c", 3)), target, "transactional", path, AS_OF)
    assert second.row_count == 1
    held = source.scan(spark, database, "SELECT * FROM stg_Customer")
    assert sorted((r.ID, r.V) for r in held.collect()) == [(1, "held"), (2, "b"), (3, "c")]
    assert ledger.read(spark, path).count() == 2
    empty = plan.load(spark, entity(), changes(spark, (2, "b", 2)), target, "transactional", path, AS_OF)
    assert (empty.row_count, empty.watermark, ledger.read(spark, path).count()) == (0, None, 2)


def test_truncating_load(spark, database, folder):
    spec = entity(write_mode="truncate_insert", excluded_columns=["seen"], suffix_columns=("ID", "V"), chunk_column="id", chunks=2)
    result = plan.load(spark, spec, changes(spark, (1, "a", 1), (2, "b", 2)), JdbcTarget(database), "daily", folder, AS_OF, governed=[1])
    assert (result.status, result.row_count) == ("written_in_chunks", 2)
    assert rows(source.scan(spark, database, "SELECT * FROM stg_Customer")) == [(1, "a-D"), (2, "b")]


def test_load_settings_are_checked(spark, database, folder):
    args = (changes(spark, (1, "a", 1)), JdbcTarget(database), "transactional", folder, AS_OF)
    assert plan.load(spark, entity(write_enabled=False), *args).status == "skipped"
    for spec, message in [
        (entity(dedupe_keys=[]), "replay"),
        (entity(write_mode="merge"), "write mode"),
        (entity(table=""), "target table"),
        (entity(watermark=None), "watermark"),
        (entity(chunks=2), "column"),
    ]:
        with pytest.raises(ValueError, match=message):
            plan.load(spark, spec, *args)
    with pytest.raises(ValueError, match="no ids"):
        plan.load(spark, entity(), *args, id_filter=("ID", [], "include"))


def test_extract_modes(spark):
    spec = entity(history_column="SEEN")
    df = changes(spark, (1, "a", 1), (2, "b", 20))
    late = dt.date(2028, 1, 10)
    assert plan.extract(spec, df, "daily", late).count() == 1
    assert plan.extract(spec, df, "initial", late).count() == 2
    assert plan.extract(entity(history_column="SEEN", keep_history_on_initial=True), df, "initial", late).count() == 1
    assert plan.extract(spec, df, "transactional", late, dt.datetime(2024, 1, 20)).count() == 0


def test_sizing():
    sizes = [0, 49_999, 50_000, 250_000, 1_000_000, 2_000_000, 5_000_000]
    assert [sink.write_partitions(n) for n in sizes] == [None, None, 8, 16, 32, 48, 64]
    assert sink.write_partitions(None) is None
    assert sink.write_options(10)["batchsize"] == "10000"
    assert sink.write_options(1_000_000)["batchsize"] == "20000"
    assert sink.write_options(60_000, {"numPartitions": 3, "batchsize": 5})["numPartitions"] == "3"


def test_dialects():
    options = source.Database("jdbc:x", "Azure_SQL", options={"fetchsize": 5, "encrypt": True}).jdbc_options()
    assert options["driver"].endswith("SQLServerDriver") and options["fetchsize"] == "5" and options["encrypt"] == "true"
    assert source.Database("jdbc:x", "oracle").jdbc_options()["sessionTimeZone"] == "America/New_York"
    with pytest.raises(ValueError, match="unsupported"):
        source.Database("jdbc:x", "mysql").jdbc_options()
    assert "datetime2" in source.change_filter_sql("mssql", "c", "2024-01-01")
    assert "timestamp_format" in source.change_filter_sql("db2", "c", "2024-01-01")
    assert "FF6" in source.change_filter_sql("oracle", "c", "2024-01-01")
    with pytest.raises(ValueError):
        source.change_filter_sql("mysql", "c", "2024-01-01")
