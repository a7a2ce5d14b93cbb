"""Merges of a change set into a base relation, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.dedupe import dedupe_latest
from tidegate.operators.membership import SPREAD, exclude_keys, spread_join, spread_of, without_held
from tidegate.operators.names import align, not_null, resolve

MATCHED = "__matched"
HELD = "__held"


def checked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; running it fails if a non-NULL key occurs twice.

    The rows themselves go through the check, so no plan that needs them can leave it out.
    """
    values = [c for c in df.columns if c not in keys]
    present = not_null(df, keys).withColumn(SPREAD, spread_of(keys))
    row = F.first(F.struct(*[F.col(c) for c in values])) if values else F.first(F.lit(True))
    counted = present.groupBy(*keys, SPREAD).agg(F.count(F.lit(1)).alias("__n"), row.alias("__row"))
    message = F.concat(F.lit("duplicate merge key "), F.to_json(F.struct(*keys)))
    repeated = F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean"))
    single = counted.where(F.coalesce(repeated, F.lit(True)))
    columns = [F.col(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    without_key = df.where(reduce(or_, [F.col(k).isNull() for k in keys]))
    return single.select(*columns).unionByName(without_key)


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    base_is_unique: bool = True,
    updates_are_unique: bool = False,
) -> DataFrame:
    """Update all columns of matched rows and insert the rest.

    NULL keys never match: such base rows stay and such updates are inserted. A non-NULL key that
    occurs twice in ``updates`` is an error unless the caller vouches for ``updates_are_unique``.
    With ``base_is_unique=False`` a key that ``base`` holds several times is updated in each of its
    rows, as a merge would; otherwise it would end up as one row.
    """
    keys = resolve(base, keys)
    if not keys:
        raise ValueError("a merge needs at least one key")
    updates = align(updates, base.schema)
    single = updates if updates_are_unique else checked(updates, keys)
    if base_is_unique:
        return exclude_keys(base, updates, keys).unionByName(single)
    values = [c for c in base.columns if c not in keys]
    new = not_null(single, keys).select(*keys, F.struct(*[F.col(c) for c in values]).alias(MATCHED))
    matched = F.col(MATCHED).isNotNull()
    updated = [F.when(matched, F.col(f"{MATCHED}.{c}")).otherwise(F.col(c)).alias(c) for c in values]
    inserted = exclude_keys(single, base, keys)
    return spread_join(base, new, keys, "left").select(*keys, *updated).select(*base.columns).unionByName(inserted)


def merge_latest(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current state after a change set in which the newer row of a key wins, whoever holds it.

    Unlike `upsert` this does not depend on the order in which batches arrive, so replayed and late
    batches are harmless.
    """
    return dedupe_latest(base.unionByName(align(updates, base.schema)), keys, order)


def absent_rows(existing_keys: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch``, one per key, whose key is not held yet. Existing rows are never updated."""
    keys = resolve(batch, keys)
    return without_held(dedupe_latest(batch, keys), existing_keys, keys)


def insert_absent(base: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``base`` plus the rows of ``batch`` whose key it does not hold."""
    return base.unionByName(absent_rows(base, align(batch, base.schema), keys))


def update_columns(
    base: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str], unique: bool = False
) -> DataFrame:
    """Set only ``columns`` on matched rows; insert unmatched updates whole. A non-NULL key that occurs
    twice on either side is an error, unless the caller vouches that both are ``unique``.

    Both sides meet in one shuffle, as rows of one key, where their numbers are checked and their values matched.
    """
    keys = resolve(base, keys)
    columns = resolve(base, columns)
    updates = align(updates, base.schema)
    values = [c for c in base.columns if c not in keys]
    ours, theirs = (F.struct(*[F.col(c) for c in values]).alias(side) for side in (HELD, MATCHED))

    def value(name: str) -> Column:
        first, second = (MATCHED, HELD) if name in columns else (HELD, MATCHED)
        chosen = F.when(F.col(first).isNotNull(), F.col(f"{first}.{name}")).otherwise(F.col(f"{second}.{name}"))
        return chosen.alias(name)

    if unique:
        met = spread_join(base.select(*keys, ours), updates.select(*keys, theirs), keys, "full")
        return met.select(*[F.col(c) if c in keys else value(c) for c in base.columns])
    sides = [
        not_null(df, keys).withColumn(SPREAD, spread_of(keys)).select(*keys, SPREAD, F.struct(*values or [F.lit(True)]).alias(side))
        for df, side in ((base, HELD), (updates, MATCHED))
    ]
    tagged = sides[0].unionByName(sides[1], allowMissingColumns=True)
    counts = [F.count(side).alias(f"{side}_n") for side in (HELD, MATCHED)]
    firsts = [F.first(side, ignorenulls=True).alias(side) for side in (HELD, MATCHED)]
    met = tagged.groupBy(*keys, SPREAD).agg(*counts, *firsts)
    message = F.concat(F.lit("duplicate merge key "), F.to_json(F.struct(*keys)))
    repeated = F.when(F.greatest(*[F.col(f"{side}_n") for side in (HELD, MATCHED)]) > 1, F.raise_error(message).cast("boolean"))
    met = met.where(F.coalesce(repeated, F.lit(True))).select(*[F.col(c) if c in keys else value(c) for c in base.columns])
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    return met.unionByName(base.where(keyless)).unionByName(updates.where(keyless))
