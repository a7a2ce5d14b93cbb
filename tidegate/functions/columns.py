"""Column expressions. All of them are built from Spark's own functions and stay in codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The status codes of the payroll export and their names.
EXPORT_STATUS = {
    100: "SentToCAPs",
    200: "ResentToCAPs",
    300: "Fail",
    400: "Preparing",
    500: "InsertingInDB2",
    600: "ReadyForPayroll",
    700: "SentForPayroll",
}

# Number of key buckets of an event table, governed-code suffix, empty-ledger watermark.
KEY_BUCKETS = 64
GOVERNED_SUFFIX = "-D"
EPOCH = dt.datetime(1900, 1, 1)


def key_bucket(keys: Iterable[str], buckets: int = KEY_BUCKETS) -> Column:
    """Bucket number of a key: a non-negative remainder of Spark's hash."""
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(buckets))


def effective_change_time(updated: str | Column, created: str | Column) -> Column:
    """When a row last changed: its update time, or its creation time if never updated."""
    return F.coalesce(_col(updated), _col(created))


def timestamp_literal(value: dt.datetime) -> Column:
    """A time without a zone as a timestamp of the session's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")


def format_watermark(ts: str | Column, digits: int = 6) -> Column:
    """Timestamp as text with a fixed number of fraction digits (3 or 6)."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss." + "S" * digits)


# The texts Spark reads as booleans.
TRUE_TEXTS = ("t", "true", "y", "yes", "1")
FALSE_TEXTS = ("f", "false", "n", "no", "0")

# Characters that occur in no text of a kind. Spark trims spaces and control characters.
NO_INTEGER = r"[^0-9+\-\s\p{Cntrl}]"
NO_DECIMAL = r"[^0-9+\-.eE\s\p{Cntrl}]"
DIGIT = r"[0-9]"
# What Spark trims before it reads a text: ASCII control characters and the space.
BLANK_ENDS = r"^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$"


def safe_cast(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """``try_cast`` that is fast on rows it cannot cast.

    Spark's ``try_cast`` raises and catches an error for each such row. A cheap test in front of it
    turns most of them into NULL; it rejects only what the cast would reject as well.
    """
    cast = column.try_cast(target)
    if isinstance(source, T.StringType):
        if isinstance(target, T.IntegralType):
            return F.when(~column.rlike(NO_INTEGER), cast)
        if isinstance(target, T.DecimalType):
            return F.when(~column.rlike(NO_DECIMAL), cast)
        if isinstance(target, T.BooleanType):
            text = F.lower(F.regexp_replace(column, BLANK_ENDS, ""))
            return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)
        if isinstance(target, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.when(column.rlike(DIGIT), cast)
    # Up to 15 digits a double tells a value that fits from the first that does not.
    if isinstance(source, T.NumericType) and isinstance(target, T.DecimalType) and target.precision <= 15:
        bound = F.lit(10.0 ** (target.precision - target.scale))
        return F.when((column < bound) & (column > -bound), cast)
    return cast


def decode(code: str | Column, names: Mapping[int, str]) -> Column:
    """Name of a numeric code. Unknown codes, and text that is no number, come back as text."""
    column = _col(code)
    text = column.cast("string")
    number = F.when(~text.rlike(NO_DECIMAL), column.try_cast("int"))
    lookup = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.coalesce(lookup[number], text)


def flag_set(column: str | Column) -> Column:
    """A 0/1 flag that counts as 0 when missing."""
    return F.coalesce(_col(column), F.lit(0)) == 1


def primary_alias(is_primary: str = "IS_PRIMARY", deleted: str = "MARK_FOR_DELETION") -> Column:
    """Predicate: the row is the primary alias and is not marked for deletion."""
    return flag_set(is_primary) & (F.coalesce(F.col(deleted), F.lit(0)) == 0)


def with_suffix(code: str | Column, governed: Column, suffix: str = GOVERNED_SUFFIX) -> Column:
    """``code`` with ``suffix`` once, where ``governed`` holds. Idempotent; NULL stays NULL."""
    column = _col(code)
    applies = governed & column.isNotNull() & ~column.endswith(suffix)
    return F.when(applies, F.concat(column, F.lit(suffix))).otherwise(column)


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
