"""Column-name resolution shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Real column names for configured ones, ignoring case; a missing name is an error."""
    by_lower = {c.lower(): c for c in df.columns}
    wanted = [n.strip() for n in names if n.strip()]
    missing = [n for n in wanted if n.lower() not in by_lower]
    if missing:
        raise ValueError(f"columns {missing} not found in {df.columns}")
    return [by_lower[n.lower()] for n in wanted]


def exclude_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop configured columns, ignoring case; a missing name is an error."""
    return df.drop(*resolve(df, names))


def not_null(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows in which none of the columns is NULL; the tests are pushed to the scan."""
    for name in names:
        df = df.where(F.col(name).isNotNull())
    return df


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """The columns of ``target``, in its order and with its types. A column that ``target`` does not
    have is an error, as its values would be lost."""
    known = {n.lower() for n in target.fieldNames()}
    added = [c for c in df.columns if c.lower() not in known]
    if added:
        raise ValueError(f"columns {added} are not among {target.fieldNames()}")
    kinds = {f.name: f.dataType for f in df.select(*target.fieldNames()).schema.fields}
    columns = [F.col(f.name) if kinds[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields]
    return df.select(*columns)


def comparable(data_type: T.DataType) -> bool:
    """Whether values of a type can be ordered and hashed (maps and variants cannot)."""
    if isinstance(data_type, T.ArrayType):
        return comparable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(comparable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def comparable_columns(df: DataFrame, excluding: Iterable[str] = ()) -> list[str]:
    skip = set(excluding)
    return [f.name for f in df.schema.fields if f.name not in skip and comparable(f.dataType)]
