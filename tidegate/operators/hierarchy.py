"""Descendants in a parent/child table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.membership import exclude_keys, include_keys
from tidegate.workspace import release, scratch_path, stage

# Rounds of level-by-level expansion before deep single-parent chains are finished by doubling.
LEVEL_ROUNDS = 4


def descendants(
    nodes: DataFrame,
    seeds: DataFrame,
    id_column: str,
    parent_column: str,
    level_rounds: int = LEVEL_ROUNDS,
    folder: str | None = None,
) -> DataFrame:
    """Ids of the seed rows and of everything below them, each once; cycles are harmless.

    ``nodes`` holds one row per (id, parent); ``seeds`` holds ids under ``id_column``, of which
    those that are no row of ``nodes`` are ignored. Ids keep the type of ``id_column``.

    The first rounds expand level by level: children of the newest level, minus what is already
    found. A level is a written table, so a small one is broadcast by its measured size and a large
    one is joined by shuffle with hot parents split; lineage never grows. If levels remain after
    ``level_rounds`` and every id left has a single parent, the rest is found by pointer doubling,
    which needs only the logarithm of the remaining depth; otherwise expansion by level goes on. Each round
    finds a new id or is the last. Once half as many ids have been found as there are edges, the edges
    of found ids are left behind, so deep graphs are not read whole in each round.
    The result reads from ``folder``, which the caller may delete when done.
    """
    spark = nodes.sparkSession
    folder = folder or scratch_path(spark, "descendants")
    kind = nodes.schema[id_column].dataType
    counted = F.count(F.lit(1)).alias("n")
    edges = stage(
        nodes.select(F.col(id_column).alias("id"), F.col(parent_column).cast(kind).alias("parent")).where(F.col("id").isNotNull()),
        "edges",
        counted,
        path=f"{folder}/edges",
    )
    level = stage(
        include_keys(edges.df.select("id"), seeds.select(F.col(id_column).cast(kind).alias("id")), ["id"]).distinct(),
        "level",
        counted,
        path=f"{folder}/found/level=0",
    )
    recent, since, rounds = [level.path], level.metrics["n"], 0
    while level.metrics["n"]:
        rounds += 1
        if rounds == level_rounds + 1 and _double(spark, edges.df, _found(spark, folder, level.df), level.df, folder):
            break
        if 2 * since >= edges.metrics["n"] > 0:
            left = edges.df.where(F.col("parent").isNotNull()).join(spark.read.parquet(*recent), "id", "left_anti")
            smaller = stage(left, "edges", counted, path=f"{folder}/edges-{rounds}")
            release(spark, edges.path)
            edges, recent, since = smaller, [], 0
        children = include_keys(
            edges.df.where(F.col("parent").isNotNull()), level.df.withColumnRenamed("id", "parent"), ["parent"], unique=True
        )
        children = children.select("id").distinct()
        if recent:
            children = children.join(spark.read.parquet(*recent), "id", "left_anti")
        level = stage(children, "level", counted, path=f"{folder}/found/level={rounds}")
        recent.append(level.path)
        since += level.metrics["n"]
    release(spark, edges.path)
    return _found(spark, folder, level.df).select(F.col("id").alias(id_column))


def _found(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/found")


def _double(spark: SparkSession, edges: DataFrame, found: DataFrame, level: DataFrame, folder: str) -> bool:
    """Finish by pointer doubling over the ids not found yet. False if some id has several parents.

    Each open id points at an ancestor and knows whether any id up to that ancestor is found. One
    round doubles the distance. Ids at every distance from the found set lie on the way to those
    further off, so a round that finds nothing ends the search.
    """
    unseen = exclude_keys(edges.where(F.col("parent").isNotNull()), found, ["id"], unique=True)
    one_parent = unseen.groupBy("id").agg(F.min("parent").alias("up"), F.max("parent").alias("other"))
    start = stage(
        one_parent, "pointers", F.max(F.col("up") != F.col("other")).alias("several"), path=f"{folder}/pointers-start"
    )
    if start.metrics["several"]:
        release(spark, start.path)
        return False
    pointers = start.df.select("id", "up")
    last = level.select(F.col("id").alias("up"), F.lit(True).alias("hit"))
    state = stage(
        pointers.join(last, "up", "left").select("id", "up", F.coalesce("hit", F.lit(False)).alias("hit")),
        "pointers",
        F.count_if("hit").alias("hits"),
        path=f"{folder}/pointers-0",
    )
    step = 0
    while state.metrics["hits"]:
        step += 1
        # A hit id is settled; an id whose pointer left the open ids without a hit never will be.
        up = state.df.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("hit").alias("hit2"))
        settled = state.df.where("hit").select("id", F.lit(None).cast(up.schema["up"].dataType).alias("up"), "hit")
        settled = settled.withColumn("new", F.lit(False))
        open_ids = state.df.where(~F.col("hit"))
        moved = open_ids.join(up, "up", "inner").where(F.col("up2").isNotNull() | F.col("hit2"))
        moved = moved.select("id", F.col("up2").alias("up"), F.col("hit2").alias("hit"), F.col("hit2").alias("new"))
        previous = state
        state = stage(
            settled.unionByName(moved).select("id", "up", "hit", "new"),
            "pointers",
            F.count_if("new").alias("hits"),
            path=f"{folder}/pointers-{step}",
        )
        release(spark, previous.path)
    stage(state.df.where("hit").select("id"), "level", path=f"{folder}/found/level=deep")
    release(spark, start.path, state.path)
    return True
