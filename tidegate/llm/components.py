"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.membership import spread_join
from tidegate.workspace import release, stage


def _least(links: DataFrame) -> DataFrame:
    """The least neighbour or self of each left end."""
    return links.groupBy("a").agg(F.min("b").alias("__m")).withColumn("__m", F.least("a", "__m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = spread_join(both, _least(both), ["a"], "inner").where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.col("__m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    moved = spread_join(down, least, ["a"], "inner").select(F.col("b").alias("a"), F.col("__m").alias("b"))
    return moved.where("a <> b").unionByName(least.select("a", F.col("__m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of ``links`` (a, b), the least node reachable being the component.

    Each round replaces links by links to the least neighbour and is written to the shared folder; the rounds
    end when nothing changes, after about log of the longest path. Links that join a node with itself and
    links with a NULL end join nothing. An empty table gives an empty one.
    """
    marks = (F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_000_007), F.lit(0)).alias("h"))
    current = stage(links.select("a", "b").where("a <> b").distinct(), "links", *marks)
    while True:
        following = stage(_small_star(_large_star(current.df)), "links", *marks)
        same = following.metrics == current.metrics
        release(links.sparkSession, current.path)
        current = following
        if same:
            break
    stars = current.df.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(centres)
