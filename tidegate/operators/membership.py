"""Keep or drop rows by membership of their key in a list or in another relation."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import safe_cast
from tidegate.operators.dedupe import distinct_keys
from tidegate.operators.names import comparable_columns, not_null, resolve

# Fixed value: the longest id list a source accepts in one IN predicate.
IN_LIST_LIMIT = 1000

SPREAD = "__spread"
MEMBER = "__member"
MODES = ("include", "exclude")


def spread_of(
    keys: Sequence[str], others: Sequence[str] = (), peers: Sequence[T.DataType] | None = None
) -> Column:
    """One bit of the hash of a key; the hash of the other columns where a key column is NULL.

    The bit makes the column depend on the key, and unlike a hash costs next to nothing in a compressed shuffle. A hash depends on the type, so where the other side of a join has other key types, ``peers``,
    both sides hash the type that Spark compares them in.
    """
    values = [F.col(k) for k in keys]
    typed = [F.coalesce(v, F.lit(None).cast(p)) for v, p in zip(values, peers, strict=True)] if peers else values
    by_key = F.xxhash64(*typed).bitwiseAND(F.lit(1))
    if not others:
        return by_key
    has_null = reduce(or_, [v.isNull() for v in values])
    return F.when(has_null, F.xxhash64(*[F.col(c) for c in others])).otherwise(by_key)


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equally named ``keys`` in which rows with a NULL key, which never match, are spread
    over all tasks by their other columns instead of meeting in one. A right side that has the
    spread column already, because it was grouped by it, is not shuffled again; its key types must
    be those of the left side."""
    types = [[df.schema[k].dataType for k in keys] for df in (left, right)]
    same = types[0] == types[1]

    def spread(df: DataFrame, peers: list[T.DataType]) -> DataFrame:
        return df.withColumn(SPREAD, spread_of(keys, comparable_columns(df, keys), None if same else peers))

    if SPREAD not in right.columns:
        right = spread(right, types[0])
    elif not same:
        raise ValueError(f"key types differ: {types[0]} and {types[1]}")
    return spread(left, types[1]).join(right, [*keys, SPREAD], how).drop(SPREAD)


def key_join(df: DataFrame, members: DataFrame, keys: Sequence[str], how: str, unique: bool = False) -> DataFrame:
    """Semi or anti join on equally named ``keys`` of which one value may own much of ``df``.

    ``members`` is made distinct first unless the caller knows it is ``unique``, so a hot value
    there is folded by the map-side aggregation. The join then uses a bit of the key's hash next to the
    key. That column does two things: rows with a NULL key are spread over all tasks; and ``members``
    arrives through its own shuffle, which is the shape in which adaptive execution splits a hot
    partition of ``df``. A small member set is broadcast by adaptive execution once its size has
    been measured; nothing is broadcast by hint.
    """
    keys = resolve(df, keys)
    if unique and how == "left_semi":
        return df.join(members.select(*keys), keys, how)
    right = members.select(*keys) if unique else distinct_keys(members, keys)
    return spread_join(df, right, keys, how).select(*df.columns)


def include_keys(df: DataFrame, members: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return key_join(df, members, keys, "left_semi", unique)


def exclude_keys(
    df: DataFrame, members: DataFrame, keys: Sequence[str], drop_nulls: bool = False, unique: bool = False
) -> DataFrame:
    """Rows whose key does not occur in ``members``.

    A NULL key is kept, as in an anti join; ``drop_nulls`` drops it, as ``NOT IN`` does.
    """
    rows = not_null(df, resolve(df, keys)) if drop_nulls else df
    return key_join(rows, members, keys, "left_anti", unique)


def without_held(distinct: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Anti join for a left side that has one row per key already: it keeps that partitioning, so
    neither side is shuffled twice."""
    return distinct.join(distinct_keys(held, keys), list(keys), "left_anti")


def listed_ids(df: DataFrame, column: str, ids: Sequence[int | str] | DataFrame) -> tuple[Column, DataFrame]:
    """What rows of ``df`` are compared by, and the distinct ids of a list in the same type.

    Ids take the type of ``column``; those that do not fit it can match nothing and go. A text column
    and numeric ids are compared as numbers, so ``'01'`` is 1 and text that is no number matches nothing.
    """
    if isinstance(ids, DataFrame):
        given = ids.select(F.col(ids.columns[0]).alias(MEMBER))
        target, key, _ = _compared_as(df, column, isinstance(given.schema[MEMBER].dataType, T.NumericType))
    else:
        target, key, numeric = _compared_as(df, column, not any(isinstance(i, str) for i in ids))
        given = df.sparkSession.createDataFrame([(str(i),) for i in dict.fromkeys(ids)], f"{MEMBER} string")
        if numeric:
            given = given.select(F.col(MEMBER).try_cast("decimal(38,0)").alias(MEMBER))
    typed = given.select(F.col(MEMBER).try_cast(target).alias(MEMBER))
    return key, not_null(typed, [MEMBER]).distinct()


def listed_values(df: DataFrame, column: str, ids: Sequence[int | str]) -> tuple[Column, list]:
    """What rows of ``df`` are compared by, and the distinct values of a short list in the same type, by the rules of
    `listed_ids`.

    They are cast as constants of a plan over one constant row, which Spark evaluates while it plans: no job runs.
    """
    target, key, numeric = _compared_as(df, column, not any(isinstance(i, str) for i in ids))
    texts = F.from_json(F.lit(json.dumps([str(i) for i in ids])), "array<string>")

    def typed(text: Column) -> Column:
        return (text.try_cast("decimal(38,0)") if numeric else text).try_cast(target)

    row = df.sparkSession.sql("VALUES (1)").select(F.transform(texts, typed).alias(MEMBER)).collect()[0]
    return key, [value for value in dict.fromkeys(row[MEMBER]) if value is not None]


def _compared_as(df: DataFrame, column: str, numeric: bool) -> tuple[T.DataType, Column, bool]:
    """The type that ids take, the column in that type, and whether the ids are numbers."""
    kind = df.schema[column].dataType
    if numeric and isinstance(kind, T.StringType):
        target = T.DecimalType(38, 9)
        return target, safe_cast(F.col(column), kind, target), numeric
    return kind, F.col(column), numeric


def filter_by_ids(
    df: DataFrame, column: str, ids: Sequence[int | str] | DataFrame, mode: str = "include"
) -> DataFrame:
    """Keep (``include``) or drop (``exclude``) rows by a list of ids, with IN / NOT IN semantics.

    The list may be values or the first column of a frame; how long it is changes nothing but the plan: up
    to the source's IN limit values are a pushed-down predicate, beyond it, and for a frame, a join.
    NULL keys are dropped in both modes, except that an empty exclude list keeps every row.
    """
    _check_mode(mode)
    (column,) = resolve(df, [column])
    frame = isinstance(ids, DataFrame)
    if ids.isEmpty() if frame else not len(ids):
        return df.where(F.lit(mode == "exclude"))
    present = F.col(column).isNotNull()
    if not frame and len(ids) <= IN_LIST_LIMIT:
        key, values = listed_values(df, column, ids)
        if mode == "include":
            return df.where(key.isin(values)) if values else df.where(F.lit(False))
        if not values:
            return df.where(present)
        plain = not isinstance(df.schema[column].dataType, T.StringType) or isinstance(values[0], str)
        return df.where(~key.isin(values)) if plain else df.where(present & ~F.coalesce(key.isin(values), F.lit(False)))
    key, listed = listed_ids(df, column, ids)
    rows = df.withColumn(MEMBER, key)
    if mode == "include":
        return include_keys(rows, listed, [MEMBER], unique=True).select(*df.columns)
    return exclude_keys(rows.where(present), listed, [MEMBER], unique=True).select(*df.columns)


def filter_by_relation(
    df: DataFrame, column: str, other: DataFrame, other_column: str, mode: str = "include"
) -> DataFrame:
    """Keep or drop rows by the distinct non-NULL ids of a sibling relation.

    ``include`` is a semi join, ``exclude`` an anti join that keeps NULL ids.
    """
    _check_mode(mode)
    (column,) = resolve(df, [column])
    (other_column,) = resolve(other, [other_column])
    members = other.select(F.col(other_column).alias(column))
    return include_keys(df, members, [column]) if mode == "include" else exclude_keys(df, members, [column])


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"unsupported filter mode '{mode}', expected one of {MODES}")
