"""Which keys of a target a batch can meet, so that no others are read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.membership import IN_LIST_LIMIT
from tidegate.sources.jdbc import literal, quantiles

# Ranges that the keys of a larger batch are read by, and ids in one IN predicate of a read.
RANGES, LIST_KEYS = 16, 250
# Types whose order is the same in every database, so that ranges of them leave nothing out.
ORDERED = (T.IntegralType, T.DecimalType, T.DateType)


@dataclass(frozen=True)
class Reach:
    """The values of a batch's first key column: all of them if they are few, else the ranges that hold them."""

    values: Sequence[object] | None = None
    ranges: Sequence[tuple[object, object]] | None = None

    def predicates(self, column: str) -> list[str]:
        """Disjoint SQL predicates that no row which the batch can meet is outside of; none if nothing is known."""
        if self.values is not None:
            parts = [self.values[k : k + LIST_KEYS] for k in range(0, len(self.values), LIST_KEYS)]
            return [f"{column} IN ({', '.join(map(_literal, part))})" for part in parts] or ["1 = 0"]
        return [f"{column} >= {literal(low)} AND {column} <= {literal(high)}" for low, high in self.ranges or ()]

    def condition(self, column: Column) -> Column | None:
        """The same for a Parquet scan, which skips row groups and pages by it."""
        if self.values is not None:
            return column.isin(list(self.values)) if self.values else F.lit(False)
        if self.ranges:
            return column.between(F.lit(self.ranges[0][0]), F.lit(self.ranges[-1][1]))
        return None


def _literal(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else literal(value)


def reach_of(batch: DataFrame, key: str) -> Reach:
    """The reach of a batch by one of its key columns.

    Up to the source's IN limit the distinct values are listed, whatever their type. Numbers and dates beyond it are
    cut into ranges of about as many rows, from the least to the greatest value of each, so that gaps between them are not read. Texts
    are ordered differently by each database, and times depend on its zone: of many of these all keys are read.
    """
    kind = batch.schema[key].dataType
    listable = isinstance(kind, (*ORDERED, T.StringType))
    if not listable:
        return Reach()
    present = batch.where(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    few = [row["k"] for row in present.distinct().limit(IN_LIST_LIMIT + 1).collect()]
    if len(few) <= IN_LIST_LIMIT:
        return Reach(values=sorted(few))
    if not isinstance(kind, ORDERED):
        return Reach()
    bounds = quantiles(present, "k", RANGES)
    part = sum((F.when(F.col("k") > F.lit(b), 1).otherwise(0) for b in bounds), F.lit(0))
    spans = present.groupBy(part.alias("part")).agg(F.min("k").alias("low"), F.max("k").alias("high")).collect()
    return Reach(ranges=sorted((row["low"], row["high"]) for row in spans))

