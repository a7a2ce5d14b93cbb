"""Nearest neighbours by cosine over low-dimensional stable projections.

Unit vectors are projected to a few dimensions by Gaussian (2-stable) directions, and a kd-tree indexes the
projections. The squared distance of a pair in projection, over its true squared distance, follows a
chi-square law with as many degrees of freedom as dimensions. A query therefore meets its projected
neighbours nearest first, each verified on the original vectors, and stops when a neighbour nearer than the
k-th found would, with probability ``certainty``, already have been met.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import ship

DIMENSIONS, LEAF, SEED = 8, 256, 11
CERTAINTY = 0.995
# Vectors that one task indexes, and queries that it answers.
BLOCK, QUERIES = 8_192, 4_096


def chi_square(x: float, freedom: int) -> float:
    """Distribution function of the chi-square law for an even number of degrees of freedom."""
    if x <= 0:
        return 0.0
    if math.isinf(x):
        return 1.0
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


class Index:
    """A kd-tree over projected unit vectors whose leaves hold the original ones.

    Equal vectors are held once with their ``spare`` least ids, of which a query can't need more.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, spare: int) -> None:
        order = np.argsort(ids, kind="stable")
        distinct, which = np.unique(vectors[order], axis=0, return_inverse=True)
        which = which.reshape(-1)
        grouped = np.argsort(which, kind="stable")
        starts = np.searchsorted(which[grouped], np.arange(len(distinct)))
        ends = np.append(starts[1:], len(which))
        self.ids = [ids[order][grouped[s : min(e, s + spare)]] for s, e in zip(starts, ends, strict=True)]
        self.vectors = distinct
        self.norms = np.sqrt((distinct * distinct).sum(axis=1))
        directions = np.random.default_rng(SEED).standard_normal((distinct.shape[1], DIMENSIONS))
        self.directions = directions
        self.points = (distinct / self.norms[:, None]) @ directions
        self.leaves: list[np.ndarray] = []
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(distinct)))

    def _build(self, rows: np.ndarray) -> int:
        points = self.points[rows]
        low, high = points.min(axis=0), points.max(axis=0)
        if len(rows) <= LEAF:
            self.nodes.append((low, high, rows, None))
        else:
            axis = int(np.argmax(high - low))
            split = np.argpartition(points[:, axis], len(rows) // 2)
            left, right = self._build(rows[split[: len(rows) // 2]]), self._build(rows[split[len(rows) // 2 :]])
            self.nodes.append((low, high, left, right))
        return len(self.nodes) - 1

    def _gap(self, node: int, point: np.ndarray) -> float:
        low, high = self.nodes[node][:2]
        beyond = np.maximum(low - point, 0) + np.maximum(point - high, 0)
        return float(beyond @ beyond)

    def search(self, own: int, vector: np.ndarray, k: int, certainty: float) -> list[tuple[float, int]]:
        """(-cosine, id) of the nearest, nearest first, ties to the smaller id."""
        norm = math.sqrt(float((vector * vector).sum()))
        point = (vector / norm) @ self.directions
        waiting = [(self._gap(self.root, point), self.root)]
        best: list[tuple[float, int]] = []
        while waiting:
            gap, node = heapq.heappop(waiting)
            if len(best) == k and gap > 0:
                distance = 2 + 2 * best[-1][0]
                if distance <= 0 or chi_square(gap / distance, DIMENSIONS) >= certainty:
                    break
            _, _, left, right = self.nodes[node]
            if right is not None:
                for child in (left, right):
                    heapq.heappush(waiting, (self._gap(child, point), child))
                continue
            scores = (self.vectors[left] * vector).sum(axis=1) / (self.norms[left] * norm)
            near = np.flatnonzero(-scores <= best[-1][0]) if len(best) == k else range(len(left))
            if len(near):
                best += [(-float(scores[i]), int(x)) for i in near for x in self.ids[left[i]] if x != own]
                best = sorted(best)[:k]
        return best


def usable(vector: Column) -> Column:
    """Whether a vector is no NULL, holds no NULL or non-finite component and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    df: DataFrame,
    every: int = 50,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    certainty: float = CERTAINTY,
    block: int = BLOCK,
) -> DataFrame:
    """The ``k`` nearest rows of each row whose key is divisible by ``every``: query_id, rank, vec_id, score.

    All usable rows are indexed, in blocks of about ``block`` vectors dealt by hash of the key; every query
    meets every block, and the best of its answers remain. Score is the cosine of the original vectors in double
    precision; ties go to the smaller key.

    Vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do rows with a NULL key.
    Vectors of different lengths are not compared. Rows with a query's key are its own; a key that occurs several
    times asks once, with its least vector, and is found once, with its best score. Fewer candidates than ``k`` are
    returned all, an empty table gives an empty result, other columns are ignored.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    asked = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    n_rows, n_asked = rows.count(), asked.count()
    blocks, chunks = max(1, -(-n_rows // block)), max(1, -(-n_asked // QUERIES))
    number = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    chunk = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int")
    held = rows.select(
        "id", "v", F.size("v").alias("d"), number.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("c")
    )
    sent = asked.select(
        "id", "v", F.size("v").alias("d"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), chunk.alias("c")
    )

    def answer(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vectors) and len(queries):
            index = Index(vectors["id"].to_numpy(), np.stack(vectors["v"].to_numpy()), k + 1)
            for own, v in zip(queries["id"], queries["v"], strict=True):
                found += [(own, x, -score) for score, x in index.search(own, np.asarray(v, float), k, certainty)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    ship(df.sparkSession)
    pairs = held.groupBy("d", "b", "c").cogroup(sent.groupBy("d", "b", "c"))
    answers = pairs.applyInPandas(answer, "query_id long, vec_id long, score double")
    best = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
