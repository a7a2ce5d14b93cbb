import pytest
from pyspark.sql import functions as F

from tidegate.operators.audit import load_report
from tidegate.sinks import tables
from tidegate.sources.tables import id_list, keyset, read_table, scan, sql_source
from tidegate.workspace import exists


def id_values(ids):
    return sorted(row[0] for row in ids.collect())


@pytest.fixture
def write(tmp_path):
    def make(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return make


def test_id_lists(spark, write, tmp_path):
    assert id_values(id_list(spark, write("a.json", '{"route_ids": [3, " 1 ", "", 3]}'))) == [1, 3]
    assert id_values(id_list(spark, write("b.json", "[5, 4]"))) == [4, 5]
    assert id_values(id_list(spark, write("c.txt", "7,\n 6\n\n7\n"))) == [6, 7]
    codes = write("d.json", '{"trip_codes": [" x", "y", ""], "trip_ids": [9]}')
    assert id_values(id_list(spark, codes, "trip_codes", "string")) == [" x", "y"]
    assert id_values(id_list(spark, codes, "trip_ids")) == [9]
    assert id_values(id_list(spark, str(tmp_path / "none.json"))) == []
    for path in (str(tmp_path / "none.txt"), write("e.txt", "\n")):
        with pytest.raises(ValueError):
            id_list(spark, path, required=True)



def test_scans(spark, folder):
    df = spark.createDataFrame([(1,), (None,), (1,)], "K int")
    tables.stage_view(df, "some_stage")
    assert scan(spark, "some_stage").count() == scan(spark, "global_temp.some_stage").count() == 3
    assert sql_source(spark, "SELECT max(k) AS m FROM some_stage").first().m == 1
    assert [str(r.k) for r in keyset(df, "k").collect()] == ["1"]
    tables.write_table(df, f"{folder}/t", "overwrite")
    assert read_table(spark, f"{folder}/t", df.schema).count() == 3


def test_transform_hook(spark):
    df = spark.range(4)
    assert tables.transform(df, None, "v") is df
    assert tables.transform(df, lambda d: d.where("id > 1"), "v").count() == 2
    assert tables.transform(df, "SELECT sum(id) AS s FROM hook_view", "hook_view").first().s == 6


def test_write_metrics_and_modes(spark, folder):
    df = spark.range(7)
    assert tables.write_table(df, f"{folder}/t", "overwrite")["rows"] == 7
    assert tables.write_table(df, f"{folder}/t", "append")["rows"] == 7
    assert spark.read.parquet(f"{folder}/t").count() == 14
    with pytest.raises(ValueError, match="mode"):
        tables.write_table(df, f"{folder}/t", "ignore")


def test_merge_rewrites_only_touched_buckets(spark, folder):
    path = f"{folder}/t"
    tables.write_bucketed(spark.range(1000).selectExpr("id", "'old' AS v"), path, ["id"], 16)
    before = files(spark, path)
    touched = tables.merge_into(spark, path, spark.createDataFrame([(5, "new"), (5000, "new")], "id bigint, v string"), ["id"], 16)
    after = files(spark, path)
    assert len(touched) <= 2
    assert {b for b in before if before[b] != after.get(b)} <= set(touched)
    rows = {r.id: r.v for r in tables.read_bucketed(spark, path).collect()}
    assert len(rows) == 1001 and {k for k, v in rows.items() if v == "new"} == {5, 5000}
    assert tables.merge_into(spark, path, spark.createDataFrame([], "id bigint, v string"), ["id"], 16) == []


def files(spark, path):
    df = spark.read.parquet(path).selectExpr("__bucket AS b", "_metadata.file_path AS f").distinct()
    found = {}
    for r in df.collect():
        found.setdefault(r.b, set()).add(r.f)
    return found


def test_replicate_touched_buckets(spark, folder):
    path, copy = f"{folder}/t", f"{folder}/copy"
    tables.write_bucketed(spark.range(100).selectExpr("id", "'a' AS v"), path, ["id"], 8)
    tables.replicate(spark, path, copy)
    touched = tables.merge_into(spark, path, spark.createDataFrame([(1, "b")], "id bigint, v string"), ["id"], 8)
    assert not tables.same_content(spark.read.parquet(path), spark.read.parquet(copy))
    before = files(spark, copy)
    tables.replicate(spark, path, copy, touched)
    assert tables.same_content(spark.read.parquet(path), spark.read.parquet(copy))
    assert {b for b, names in files(spark, copy).items() if names != before[b]} == set(touched)


def test_interrupted_swap_is_completed(spark, folder):
    path = f"{folder}/t"
    tables.write_table(spark.range(5), path, "overwrite")
    tables.rename(spark, path, f"{path}__old")
    tables.restore_table(spark, path)
    assert spark.read.parquet(path).count() == 5
    tables.replace_table(spark, path, spark.read.parquet(path).where("id > 1"))
    assert spark.read.parquet(path).count() == 3
    assert not exists(spark, f"{path}__old") and not exists(spark, f"{path}__new")


def test_compaction_clusters_by_key(spark, folder):
    path = f"{folder}/t"
    tables.write_table(spark.range(1000).repartition(20), path, "overwrite")
    tables.compact(spark, path, ["id"], 4)
    spans = spark.read.parquet(path).selectExpr("id", "_metadata.file_path AS f").groupBy("f").agg({"id": "min", "id": "max"})
    assert spans.count() <= 4 and spark.read.parquet(path).count() == 1000


def test_load_report(spark):
    assert [tuple(r) for r in load_report(spark, {"b": 2, "a": None}).collect()] == [("a", None), ("b", 2)]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
@pytest.mark.parametrize("order", [[], ["t"]])
def test_merge_by_broadcast_and_by_shuffle(spark, folder, conf, limit, order):
    conf(spark__sql__autoBroadcastJoinThreshold=limit)
    path = f"{folder}/t"
    schema = "k string, t int"
    tables.write_bucketed(spark.createDataFrame([("a", 5), ("b", 5), (None, 1)], schema), path, ["k"], 4)
    tables.merge_into(spark, path, spark.createDataFrame([("a", 9), ("b", 1), ("c", 1), (None, 2)], schema), ["k"], 4, order)
    rows = sorted(((r.k or "", r.t) for r in tables.read_bucketed(spark, path).collect()))
    expected = [("", 2), ("a", 9), ("b", 5), ("c", 1)] if order else [("", 1), ("", 2), ("a", 9), ("b", 1), ("c", 1)]
    assert rows == expected
    if not order:
        with pytest.raises(Exception, match="duplicate merge key"):
            tables.merge_into(spark, path, spark.createDataFrame([("z", 1), ("z", 2)], schema), ["k"], 4)
        assert sorted(((r.k or "", r.t) for r in tables.read_bucketed(spark, path).collect())) == expected


def test_small_merge_matches_the_table_where_it_is_read(spark, folder):
    path = f"{folder}/t"
    tables.write_bucketed(spark.range(100).selectExpr("id", "'a' AS v"), path, ["id"], 4)
    base = spark.read.parquet(path)
    changes = spark.createDataFrame([(1, "b")], "id bigint, v string").withColumn(tables.BUCKET, tables.key_bucket(["id"], 4))
    plan = tables._split_merge(base, changes, ["id"], [])._jdf.queryExecution().executedPlan().toString()
    above_scan = plan[: plan.index("FileScan parquet")]
    assert "BroadcastHashJoin" in above_scan and "Exchange hashpartitioning" not in above_scan.split("BroadcastHashJoin")[0]


def test_merge_refuses_another_layout(spark, folder):
    path = f"{folder}/t"
    tables.write_bucketed(spark.range(500).selectExpr("id", "'a' AS v"), path, ["id"], 8)
    changes = spark.range(400, 600).selectExpr("id", "'b' AS v")
    with pytest.raises(Exception, match="not laid out in 16 buckets"):
        tables.merge_into(spark, path, changes, ["id"], 16)
    assert tables.read_bucketed(spark, path).where("v = 'b'").count() == 0


def test_a_merge_that_dies_while_it_swaps_is_finished_by_the_next_one(spark, folder, monkeypatch):
    path, schema = f"{folder}/t", "id int, v string"
    tables.write_bucketed(spark.createDataFrame([(i, "old") for i in range(40)], schema), path, ["id"], 8)
    changes = spark.createDataFrame([(i, "new") for i in range(0, 60, 2)], schema)
    real, calls = tables.rename, []

    def dying(session, source, target):
        if len(calls) == 3:
            raise KeyboardInterrupt
        calls.append(target)
        real(session, source, target)

    monkeypatch.setattr(tables, "rename", dying)
    with pytest.raises(KeyboardInterrupt):
        tables.merge_into(spark, path, changes, ["id"])
    monkeypatch.setattr(tables, "rename", real)
    expected = {i: "new" if i % 2 == 0 else "old" for i in range(40)} | {i: "new" for i in range(40, 60, 2)}
    tables.restore_table(spark, path)
    assert {r.id: r.v for r in spark.read.parquet(path).collect()} == expected
    tables.merge_into(spark, path, changes, ["id"])
    assert {r.id: r.v for r in spark.read.parquet(path).collect()} == expected


def test_a_merge_costs_what_it_changes(spark, folder):
    path, schema = f"{folder}/t", "id int, v string"
    buckets = tables.buckets_for(1024 * 1000, target=1000)
    assert buckets == 1024
    tables.write_bucketed(spark.range(20_000).selectExpr("CAST(id AS int) AS id", "'old' AS v"), path, ["id"], buckets)
    before = set(spark.read.parquet(path).inputFiles())
    for step in range(3):
        tables.merge_into(spark, path, spark.createDataFrame([(i * 31, f"s{step}") for i in range(50)], schema), ["id"])
        if not step:
            assert len(before & set(spark.read.parquet(path).inputFiles())) >= 0.9 * len(before)
    assert len(spark.read.parquet(path).inputFiles()) <= len(before)
    assert spark.read.parquet(path).where("v = 's2'").count() == 50
    with pytest.raises(ValueError, match="1024"):
        tables.merge_into(spark, path, spark.createDataFrame([(1, "x")], schema), ["id"], 64)


def test_added_columns_are_refused(spark, folder):
    path = f"{folder}/t"
    tables.write_table(spark.createDataFrame([(1, "a")], "id int, v string"), path, "append")
    wider = spark.createDataFrame([(2, "b", 3)], "id int, v string, extra int")
    with pytest.raises(ValueError, match="extra"):
        tables.write_table(wider, path, "append")
    tables.write_bucketed(spark.createDataFrame([(1, "a")], "id int, v string"), f"{path}b", ["id"], 4)
    with pytest.raises(ValueError, match="extra"):
        tables.merge_into(spark, f"{path}b", wider, ["id"])


def test_replica_of_an_append_gets_new_files_only(spark, folder):
    path, copy = f"{folder}/t", f"{folder}/copy"
    first, more = (spark.createDataFrame(rows, "id int, v string") for rows in ([(1, "a")], [(2, "b")]))
    tables.write_table(first, path, "append")
    tables.replicate(spark, path, copy, added=first)
    held = set(spark.read.parquet(copy).inputFiles())
    tables.write_table(more, path, "append")
    tables.replicate(spark, path, copy, added=more)
    assert held < set(spark.read.parquet(copy).inputFiles())
    assert tables.same_content(spark.read.parquet(path), spark.read.parquet(copy))


def test_compaction_keeps_buckets(spark, folder):
    tables.write_bucketed(spark.range(100).selectExpr("id", "id % 3 AS v"), folder, ["id"], 8)
    tables.compact(spark, folder, ["id"])
    assert tables.BUCKET in spark.read.parquet(folder).columns
    assert tables.held_buckets(spark, folder) == 8
    assert tables.merge_into(spark, folder, spark.createDataFrame([(1, 9)], "id bigint, v bigint"), ["id"]) != []


def test_a_hot_key_is_split_when_clustering(spark):
    rows = spark.range(4000).selectExpr("IF(id % 10 < 9, 1, id) AS k", "id")
    parts = tables.cluster_by_key(rows, ["k"], 8).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in parts) < 2000
