import datetime as dt

from tidegate.sinks import ledger
from tidegate.sinks.tables import read_bucketed
from tidegate.streaming.loads import dedupe_within, stream_upsert, upsert_batch

SCHEMA = "k int, t timestamp, v string"


def rows(spark, *items):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, 1, 0, m), v) for k, m, v in items], SCHEMA)


def content(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_late_and_replayed_batches(spark, folder):
    target, book = f"{folder}/t", f"{folder}/ledger"
    apply = upsert_batch(target, ["k"], ["t"], book, "s", buckets=4)
    first, late = rows(spark, (1, 5, "new"), (2, 5, "x")), rows(spark, (1, 1, "old"), (3, 1, "y"))
    for batch, number in ((first, 0), (late, 1), (first, 0), (late, 1)):
        apply(batch, number)
    assert content(read_bucketed(spark, target)) == [(1, "new"), (2, "x"), (3, "y")]
    names = sorted(r.TABLE_NAME for r in ledger.read(spark, book).collect())
    assert names == ["s#0", "s#1"]
    apply(first.limit(0), 2)
    assert ledger.read(spark, book).count() == 2


def test_stream_resumes(spark, folder):
    source, target, mark = f"{folder}/in", f"{folder}/t", f"{folder}/checkpoint"
    for batch in (rows(spark, (1, 1, "a"), (2, 1, "b")), rows(spark, (1, 2, "A"), (3, 1, "c"))):
        batch.write.mode("append").parquet(source)
        changes = spark.readStream.schema(SCHEMA).parquet(source)
        stream_upsert(changes, target, mark, ["k"], ["t"], buckets=4).awaitTermination()
    assert content(read_bucketed(spark, target)) == [(1, "A"), (2, "b"), (3, "c")]


def test_bounded_dedupe(spark, folder):
    rows(spark, (1, 1, "a"), (1, 2, "b"), (2, 1, "c")).coalesce(1).write.parquet(f"{folder}/in")
    changes = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    run = dedupe_within(changes, ["k"], "t", "10 minutes").writeStream.format("parquet")
    run = run.option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True)
    run.start().awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2]
