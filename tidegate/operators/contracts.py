"""Column contracts: names, types, nullability and text lengths of a target."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions import safe_cast
from tidegate.operators.names import resolve

REASONS = "__reasons"

# SQL Server column types and the Spark types that carry them.
SQL_SERVER_TYPES = {
    "INT": "INT",
    "BIGINT": "BIGINT",
    "TINYINT": "SMALLINT",
    "BIT": "BOOLEAN",
    "DATE": "DATE",
    "TIME": "STRING",
    "DATETIME2": "TIMESTAMP",
    "DECIMAL": "DECIMAL",
    "NVARCHAR": "VARCHAR",
}


# Length of a text column that has no limit.
UNBOUNDED_TEXT = 2**31 - 1


def spark_type(sql_server_type: str) -> str:
    """Spark DDL type of a SQL Server type; precision and text length are kept where Spark has them."""
    name, _, arguments = sql_server_type.strip().upper().partition("(")
    if name not in SQL_SERVER_TYPES:
        raise ValueError(f"unsupported column type '{sql_server_type}'")
    keeps = arguments and name in ("DECIMAL", "NVARCHAR")
    return SQL_SERVER_TYPES[name] + (f"({arguments}" if keeps else "")


@dataclass(frozen=True)
class Contract:
    """A target's shape. ``required`` columns must be present; other missing ones become NULL."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()

    @staticmethod
    def from_ddl(name: str, ddl: str, keys: Sequence[str] = ()) -> Contract:
        """From Spark DDL, e.g. ``"DriverId INT NOT NULL, FirstName VARCHAR(25) NOT NULL"``."""
        return Contract(name, T.StructType.fromDDL(ddl), tuple(keys))

    @staticmethod
    def from_sql_server(name: str, columns: Iterable[tuple[str, str, bool]], keys: Sequence[str] = ()) -> Contract:
        """From (column, SQL Server type, nullable) rows, such as a catalog query returns."""
        ddl = ", ".join(f"`{c}` {spark_type(t)}{'' if nullable else ' NOT NULL'}" for c, t, nullable in columns)
        return Contract.from_ddl(name, ddl, keys)

    @staticmethod
    def from_information_schema(name: str, columns: DataFrame, keys: Sequence[str] = ()) -> Contract:
        """From a target's rows of INFORMATION_SCHEMA.COLUMNS, one per column of the table."""
        length = F.when(F.col("CHARACTER_MAXIMUM_LENGTH") > 0, F.col("CHARACTER_MAXIMUM_LENGTH")).otherwise(UNBOUNDED_TEXT)
        kind = F.upper("DATA_TYPE")
        sized = F.when(kind == "DECIMAL", F.format_string("DECIMAL(%d,%d)", "NUMERIC_PRECISION", "NUMERIC_SCALE"))
        sized = sized.when(kind == "NVARCHAR", F.format_string("NVARCHAR(%d)", length)).otherwise(kind)
        ordered = columns.orderBy("ORDINAL_POSITION").select("COLUMN_NAME", sized, F.col("IS_NULLABLE") == "YES")
        return Contract.from_sql_server(name, [tuple(row) for row in ordered.collect()], keys)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_schema(self) -> T.StructType:
        """Schema of the table behind the contract: text columns without their length."""
        return T.StructType([T.StructField(f.name, _stored_type(f.dataType), f.nullable) for f in self.schema.fields])

    def check_columns(self, df: DataFrame) -> None:
        """The frame must have exactly the contract's columns, in order, and the keys among them."""
        if df.columns != self.columns:
            raise ValueError(f"{self.name}: columns {df.columns} differ from the contract {self.columns}")
        missing = [k for k in self.keys if k not in self.columns]
        if missing:
            raise ValueError(f"{self.name}: keys {missing} are no columns of the contract")


def _stored_type(kind: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(kind, (T.VarcharType, T.CharType)) else kind


def _checks(field: T.StructField, source: Column, kind: T.DataType) -> tuple[Column, list[Column]]:
    value = safe_cast(source, kind, _stored_type(field.dataType))
    problems = [F.when(source.isNotNull() & value.isNull(), F.lit(f"{field.name}: not a {field.dataType.simpleString()}"))]
    if not field.nullable:
        problems.append(F.when(source.isNull(), F.lit(f"{field.name}: missing")))
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        problems.append(F.when(F.char_length(value) > field.dataType.length, F.lit(f"{field.name}: too long")))
    return value, problems


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Every row with its contract columns cast, the row as read, and the reasons it breaks the contract.

    Columns are matched by name ignoring case; a column the input lacks is an error. The result has
    the contract's columns, ``__row`` (the input as JSON) and ``__reasons``; `accepted` and
    `rejected` split it. Nothing is dropped here, so one pass can feed both.
    """
    names = resolve(df, contract.columns)
    values, problems = [], []
    for field, name in zip(contract.schema.fields, names, strict=True):
        value, found = _checks(field, F.col(name), df.schema[name].dataType)
        values.append(value.alias(field.name))
        problems += found
    return df.select(*values, F.to_json(F.struct(*df.columns)).alias("__row"), F.array_compact(F.array(*problems)).alias(REASONS))


def accepted(conformed: DataFrame) -> DataFrame:
    """Rows that meet the contract, with its columns only."""
    return conformed.where(F.size(REASONS) == 0).drop("__row", REASONS)


def rejected(conformed: DataFrame) -> DataFrame:
    """Rows that break the contract: the input row as JSON and its reasons."""
    broken = conformed.where(F.size(REASONS) > 0)
    return broken.select(F.col("__row").alias("row"), F.array_join(REASONS, "; ").alias("reasons"))


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How unique a key is: rows, distinct keys, keys held more than once."""
    per_key = df.groupBy(*resolve(df, keys)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_key_count"),
    )


def non_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, and distinct keys no part of which is NULL."""
    keys = resolve(df, keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count_if(present).alias("key_count"))
