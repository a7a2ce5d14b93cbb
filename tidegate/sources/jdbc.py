"""JDBC sources."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Source databases with their driver classes and default read options.
DRIVERS = {
    "oracle": "oracle.jdbc.driver.OracleDriver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "db2": "com.ibm.db2.jcc.DB2Driver",
}
DIALECT_NAMES = {"sql_server": "sqlserver", "azure_sql": "sqlserver", "mssql": "sqlserver"}
DEFAULT_OPTIONS = {
    "oracle": {
        "fetchsize": "1000",
        "isolationLevel": "READ_COMMITTED",
        "oracle.net.encryption_client": "REQUIRED",
        "oracle.net.crypto_checksum_client": "REQUIRED",
        "oracle.jdbc.timezoneAsRegion": "false",
        "user.timezone": "UTC",
        "sessionTimeZone": "America/New_York",
    },
    "sqlserver": {"fetchsize": "10000"},
    "db2": {"fetchsize": "10000"},
}

PARTITION_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


@dataclass(frozen=True)
class Database:
    """A JDBC database; ``options`` are passed through as text and win over the defaults."""

    url: str
    dialect: str = ""
    driver: str = ""
    options: Mapping[str, object] = field(default_factory=dict)

    def jdbc_options(self) -> dict[str, str]:
        dialect = self.dialect.strip().lower()
        dialect = DIALECT_NAMES.get(dialect, dialect)
        if not self.driver and dialect not in DRIVERS:
            raise ValueError(f"unsupported database '{self.dialect}', expected one of {sorted(DRIVERS)}")
        base = {"url": self.url, "driver": self.driver or DRIVERS[dialect], **DEFAULT_OPTIONS.get(dialect, {})}
        return base | {k: _text(v) for k, v in self.options.items()}


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _source(query: str) -> str:
    return f"({query.strip().rstrip(';')}) src"


def scan(spark: SparkSession, db: Database, query: str) -> DataFrame:
    """Rows of a source query. Filters and column choices on the result are pushed into it."""
    return spark.read.format("jdbc").options(**db.jdbc_options()).option("dbtable", _source(query)).load()


def partitioned_scan(spark: SparkSession, db: Database, query: str, column: str, partitions: int) -> DataFrame:
    """The same rows read by ``partitions`` tasks over ranges of a numeric, date or time column.

    The bounds come from a min/max probe of the source. They only place the ranges: rows outside
    them and rows with a NULL column are read too.
    """
    low, high = scan(spark, db, f"SELECT MIN({column}) AS LO, MAX({column}) AS HI FROM {_source(query)}").first()
    if low is None:
        return scan(spark, db, query)
    if isinstance(low, (int, float, decimal.Decimal)):
        # Spark reads bounds of a numeric column as whole numbers.
        low, high = math.floor(low), math.ceil(high)
    bounds = {"partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": partitions}
    reader = spark.read.format("jdbc").options(**db.jdbc_options()).options(**{k: str(v) for k, v in bounds.items()})
    return reader.option("dbtable", _source(query)).load()


def predicate_scan(spark: SparkSession, db: Database, query: str, predicates: Sequence[str]) -> DataFrame:
    """The same rows read by one task per predicate, for keys that are no number or time.

    The predicates must be disjoint and together cover every row.
    """
    options = {k: v for k, v in db.jdbc_options().items() if k not in PARTITION_OPTIONS}
    url = options.pop("url")
    return spark.read.jdbc(url, _source(query), predicates=list(predicates), properties=options)


def literal(value: object) -> str:
    """A number, date or time as every JDBC driver reads it."""
    if isinstance(value, dt.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, dt.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    return format(value, "f") if isinstance(value, decimal.Decimal) else repr(value)


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Disjoint predicates that cover every row: below the first bound with the NULLs, between bounds, from the last on."""
    marks = [literal(b) for b in dict.fromkeys(bounds)]
    if not marks:
        return [f"({column} IS NULL OR {column} IS NOT NULL)"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(marks, marks[1:], strict=False)]
    return [f"({column} IS NULL OR {column} < {marks[0]})", *inner, f"{column} >= {marks[-1]}"]


def quantiles(df: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[object]:
    """The values that cut a number, date or time column into ``parts`` of about as many rows."""
    if parts < 2:
        return []
    shares = [k / parts for k in range(1, parts)]
    found = df.agg(F.percentile_approx(F.col(column), shares, accuracy).alias("q")).first()["q"]
    return list(dict.fromkeys(found or []))


def balanced_scan(spark: SparkSession, db: Database, query: str, column: str, partitions: int, probe_tasks: int | None = None) -> DataFrame:
    """The rows of a query read by about ``partitions`` tasks that have about as many rows each, however the values of a
    number, date or time column are spread.

    The bounds are quantiles of the column, which alone is read for them, over equal ranges by ``probe_tasks``. They only place the
    ranges: rows with a NULL, and rows added since, are read too. A value that more rows share than a task is to have gets
    a task of its own, which no range can split.
    """
    narrow = f"SELECT {column} AS C FROM {_source(query)} WHERE {column} IS NOT NULL"
    probe = partitioned_scan(spark, db, narrow, "C", probe_tasks or partitions)
    return predicate_scan(spark, db, query, range_predicates(column, quantiles(probe, probe.columns[0], partitions)))


def key_scan(spark: SparkSession, db: Database, query: str, keys: Sequence[str], predicates: Sequence[str] = ()) -> DataFrame:
    """Distinct non-NULL keys of a source query; the database makes them distinct first."""
    columns = ", ".join(keys)
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    distinct = f"SELECT DISTINCT {columns} FROM {_source(query)} WHERE {present}"
    options = {k: v for k, v in db.options.items() if k not in PARTITION_OPTIONS}
    plain = Database(db.url, db.dialect, db.driver, options)
    if predicates:
        return predicate_scan(spark, plain, distinct, predicates).distinct()
    return scan(spark, plain, distinct).distinct()


def change_filter_sql(dialect: str, column: str, last: str) -> str:
    """The watermark predicate in a source's own SQL, for a source that Spark cannot push it to."""
    name = DIALECT_NAMES.get(dialect.lower(), dialect.lower())
    forms = {
        "oracle": f"{column} > to_timestamp('{last}', 'YYYY-MM-DD HH24:MI:SS.FF6')",
        "sqlserver": f"{column} > CAST('{last}' AS datetime2)",
        "db2": f"{column} > timestamp_format('{last}', 'YYYY-MM-DD HH24:MI:SS.FF6')",
    }
    if name not in forms:
        raise ValueError(f"unsupported database '{dialect}'")
    return forms[name]


def row_count(df: DataFrame) -> int:
    """Rows of a scan, counted by the source where Spark can push the count."""
    return df.agg(F.count(F.lit(1))).first()[0]
