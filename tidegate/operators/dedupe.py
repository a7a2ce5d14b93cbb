"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.names import comparable_columns, not_null, resolve

BEST = "__best"


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Latest row per key: every order column descending, NULLs last.

    Rows that tie on the order columns are ranked by their remaining columns, so the survivor does
    not depend on how the input is split; only rows equal in all of them are interchangeable. The
    extra columns are compared only on a tie. No keys leaves the input unchanged; no order ranks by
    the remaining columns alone. NULL keys form one group.

    The row is found as the largest struct of (order columns, other columns) of its key, in which a
    NULL is smallest. As an aggregate it is taken on both sides of the shuffle: a map task sends at
    most one row per key, so a hot key never gathers in one task. It gives the row that
    ``row_number() = 1`` over the same order gives, with fewer columns to sort by.
    """
    keys = resolve(df, keys)
    if not keys:
        return df
    ranked = [c for c in resolve(df, order) if c not in keys]
    ranked += comparable_columns(df, excluding=[*keys, *ranked])
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct().select(*df.columns)
    if len(ranked) == len(others):
        best = F.max(F.struct(*ranked))
    else:
        rank = F.struct(*ranked) if ranked else F.lit(0)
        best = F.max_by(F.struct(*others), rank)
    return df.groupBy(*keys).agg(best.alias(BEST)).select(*[F.col(c) if c in keys else F.col(f"{BEST}.`{c}`") for c in df.columns])


def distinct_keys(df: DataFrame, keys: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """Distinct key values, by default without rows in which a key is NULL."""
    keys = resolve(df, keys)
    selected = df.select(*keys)
    return (selected if keep_nulls else not_null(selected, keys)).distinct()


def union_distinct(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union by column name with one row per key."""
    union = first.unionByName(second)
    return union.distinct() if set(keys) == set(union.columns) else dedupe_latest(union, keys)
