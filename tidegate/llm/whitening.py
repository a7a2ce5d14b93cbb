"""Whitening of embeddings by a covariance that is found by polarisation.

Entries become integers. One pass gives their sums, a second the sums of squares of every centred dimension and of
every sum of two centred dimensions, all exact. Half of what the square of a sum has over the squares of its two
terms is their product, so differences of these variances give every covariance without a product of two
dimensions. The matrix, one number for each pair of dimensions, is assembled on the driver for `eigh`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.common import ship

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
# Vectors that a task holds as a matrix at a time.
ROWS = 2_048
# Exact sums travel as so many digits of 32 bits.
LIMBS, LIMB = 8, 32
# Entries whose integers lie beyond are taken as this far away.
FURTHEST = 2**60
# A component of less than this share of the whole variance is no more than rounding.
LEAST_SHARE = 1e-12


def integers(values: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 of doubles, exact."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * values), -float(FURTHEST), float(FURTHEST)).astype(np.int64) + OFFSET


def squares(y: np.ndarray) -> list[int]:
    """The exact sums of squares of every dimension and of every sum of two, in the order of `pairs`."""
    widest = int(np.abs(y).max(initial=0)) if y.size else 0
    # A sum of two has one bit more than its terms, its square twice as many.
    if len(y) * (2 * widest) ** 2 >= 2**63 or widest >= 2**61:
        y = y.astype(object)
    found: list[int] = []
    for i in range(y.shape[1]):
        own = y[:, i]
        sums = y[:, i:] + own[:, None]
        sums[:, 0] = own
        found += [int(v) for v in (sums * sums).sum(axis=0)]
    return found


def pairs(d: int) -> list[tuple[int, int]]:
    """The places in a sum of squares: (i, i) for a dimension, (i, j) for the sum of two."""
    return [(i, j) for i in range(d) for j in range(i, d)]


def limbs(value: int) -> list[int]:
    """Digits of 32 bits, least first; the sign is with the last."""
    return [value >> (LIMB * k) & (2**LIMB - 1) for k in range(LIMBS - 1)] + [value >> (LIMB * (LIMBS - 1))]


def of_limbs(digits: list[int]) -> int:
    return sum(int(v) << (LIMB * k) for k, v in enumerate(digits))


@dataclass(frozen=True)
class Fit:
    """What the fit list of ``n`` vectors gives: exact sums, covariance, components and their variances."""

    n: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    components: np.ndarray
    variances: np.ndarray

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    @property
    def centre(self) -> np.ndarray:
        """The whole part of each mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """What the sums have beyond ``n`` times the whole part."""
        return [s % self.n for s in self.sums]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on the components, each over the root of its variance."""
        centred = (x - self.centre) - np.array([r / self.n for r in self.rest])
        return centred @ self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n x - S)^2, exact, of each row."""
        y, rest = x - self.centre, np.array(self.rest, object)
        widest = int(np.abs(y).max(initial=0)) if y.size else 0
        if y.shape[1] * max(widest, self.n) * widest >= 2**63:
            y = y.astype(object)
        else:
            rest = rest.astype(np.int64)
        own, mixed, fixed = (y * y).sum(axis=1), (y * rest).sum(axis=1), sum(r * r for r in self.rest)
        return [self.n * (self.n * int(a) - 2 * int(b)) + fixed for a, b in zip(own, mixed, strict=True)]


def _matrices(batches: Iterator[pa.RecordBatch], column: int, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches, and their vectors as integers."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, integers(part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d))


def _exact_sums(df: DataFrame, d: int, centre: np.ndarray | None) -> list[int]:
    """Exact sums over all vectors, added up in each task and then place by place.

    Without a ``centre`` the number of vectors and the sums of the dimensions, with one the `squares`.
    """
    schema = "place int, digits array<long>"
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] | None = None
        for part, x in _matrices(batches, 0, d):
            if centre is not None:
                found = squares(x - centre)
            else:
                # Halves of 32 bits can't overflow in so few rows.
                high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
                found = [part.num_rows, *((int(h) << 32) + int(v) for h, v in zip(high, low, strict=True))]
            total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        if total is not None:
            places = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([places, pa.array([limbs(v) for v in total], out[1].type)], schema=out)

    rows = df.select("v").mapInArrow(run, schema)
    digits = [F.sum(F.col("digits")[k]).alias(f"d{k}") for k in range(LIMBS)]
    found = sorted(rows.groupBy("place").agg(*digits).collect())
    return [of_limbs(r[1:]) for r in found]


def finite(vector: Column) -> Column:
    """Whether a vector is no NULL and holds no NULL or non-finite entry."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))


def usable(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(``k``, ``v``) of the vectors that take part, and their length; 0 if there are none."""
    rows = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(finite(F.col("v")) & (F.size("v") > 0))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return (rows.where(F.size("v") == first["d"]), first["d"]) if first else (rows, 0)


def covariance(d: int, n: int, sums: list[int], found: list[int]) -> np.ndarray:
    """The covariances from exact sums of squares around the whole part of the means.

    Around the means themselves the product sum of i and j is less by rest_i rest_j / n, so all stays a fraction of
    whole numbers, which is rounded once.
    """
    at = {pair: value for pair, value in zip(pairs(d), found, strict=True)}
    rest = [s % n for s in sums]
    out = np.zeros((d, d))
    for i, j in pairs(d):
        product = at[i, i] if i == j else (at[i, j] - at[i, i] - at[j, j]) // 2
        out[i, j] = out[j, i] = (n * product - rest[i] * rest[j]) / (n * n)
    return out


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """The fit over all vectors of ``df`` that take part; None if there are none.

    What reaches the driver is one sum for each pair of dimensions, whatever the number of rows.
    """
    rows, d = usable(df, key, vector)
    if not d:
        return None
    return _fit(rows, d, components)


def _fit(rows: DataFrame, d: int, components: int) -> Fit:
    ship(rows.sparkSession)
    n, *sums = _exact_sums(rows, d, None)
    centre = np.array([s // n for s in sums], np.int64)
    matrix = covariance(d, n, sums, _exact_sums(rows, d, centre))
    variances, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-variances, kind="stable")[:components]
    order = order[variances[order] > LEAST_SHARE * max(float(np.trace(matrix)), 0.0)]
    return Fit(n, tuple(sums), matrix, vectors[:, order], variances[order])


def _identity_error(rows: DataFrame, fitted: Fit, d: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, over all of them."""
    k = len(fitted.variances)
    schema = "place int, value double"
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for _, x in _matrices(batches, 0, d):
            w = np.column_stack([fitted.whiten(x), np.ones(len(x))])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range((k + 1) ** 2), pa.int32()), pa.array(total.ravel())], schema=out)

    sums = rows.select("v").mapInArrow(run, schema).groupBy("place").agg(F.sum("value")).collect()
    total = np.array([v for _, v in sorted(sums)]).reshape(k + 1, k + 1) / fitted.n
    mean = total[k, :k]
    return float(np.abs(total[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``key``, component (from 1), n, deviation (decimal), whitened, explained and identity_error of each vector that
    takes part and each component, by falling variance.

    Vectors that are NULL, empty, or hold NULL or non-finite entries take no part; nor do those of another length
    than the most frequent one (the longer of equally frequent ones). Entries whose integers are beyond 2^60 count as
    2^60. Rows with a NULL or repeated key and repeated rows count and come out each by itself; other columns are
    ignored, whatever their names. Components without variance (fewer distinct vectors than dimensions, equal
    vectors, one row) are left out, so an empty table, or one vector alone, gives no rows.
    """
    rows, d = usable(df, key, vector)
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    fitted = _fit(rows, d, components) if d else None
    if fitted is None or not len(fitted.variances):
        return df.sparkSession.createDataFrame([], schema)
    error = _identity_error(rows, fitted, d)
    out = to_arrow_schema(T.StructType.fromDDL(schema))
    explained = fitted.variances / fitted.trace
    count = len(explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches, 1, d):
            rows_of = np.repeat(np.arange(len(x)), count)
            deviations = pa.array([_decimal(v) for v in fitted.deviations(x)], out[3].type)
            columns = [
                part.column(0).take(pa.array(rows_of)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows_of), fitted.n)),
                deviations.take(pa.array(rows_of)),
                pa.array(fitted.whiten(x).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(rows_of), error)),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    return rows.mapInArrow(run, schema)


def _decimal(value: int) -> int | None:
    """What has more than 38 digits is NULL."""
    return value if value < 10**38 else None


def whitened_rows(df: DataFrame) -> DataFrame:
    """`whiten` with the deviation as a long; NULL where it has more than 63 bits."""
    found = whiten(df)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
