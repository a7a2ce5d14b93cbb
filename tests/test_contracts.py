import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.contracts import Contract, accepted, conform, key_report, rejected, spark_type


@pytest.fixture
def driver(spark):
    columns = [
        ("DriverId", "INT", False),
        ("FirstName", "NVARCHAR(5)", False),
        ("IsActive", "BIT", False),
        ("HireDate", "DATE", True),
        ("Pay", "DECIMAL(5,2)", True),
    ]
    return Contract.from_sql_server("Driver", columns, ["DriverId"])


def test_rows_are_split_with_reasons(spark, driver):
    rows = [
        ("1", "Ann", "1", "2024-01-02", "999.99"),
        ("2", "Roberto", "0", None, None),
        ("3", None, "true", None, None),
        ("4", "Li", "1", None, "1000.00"),
        ("x", "Li", "1", "soon", None),
    ]
    df = spark.createDataFrame(rows, "driverid string, firstname string, isactive string, hiredate string, pay string")
    checked = conform(df, driver)
    good = accepted(checked)
    assert good.columns == driver.columns
    assert [r.asDict() for r in good.collect()] == [
        {"DriverId": 1, "FirstName": "Ann", "IsActive": True, "HireDate": dt.date(2024, 1, 2), "Pay": __import__("decimal").Decimal("999.99")}
    ]
    reasons = {json.loads(r.row)["driverid"]: r.reasons for r in rejected(checked).collect()}
    assert reasons == {
        "2": "FirstName: too long",
        "3": "FirstName: missing",
        "4": "Pay: not a decimal(5,2)",
        "x": "DriverId: not a int; HireDate: not a date",
    }


def test_missing_column_is_an_error(spark, driver):
    with pytest.raises(ValueError, match="not found"):
        conform(spark.createDataFrame([(1,)], "DriverId int"), driver)


def test_types():
    assert [spark_type(t) for t in ("NVARCHAR(20)", "BIT", "TINYINT", "TIME(7)", "DATETIME2(7)", "decimal(9,2)", "BIGINT")] == [
        "VARCHAR(20)", "BOOLEAN", "SMALLINT", "STRING", "TIMESTAMP", "DECIMAL(9,2)", "BIGINT",
    ]
    with pytest.raises(ValueError):
        spark_type("XML")


def test_column_list(spark, driver):
    df = spark.createDataFrame([], driver.stored_schema)
    driver.check_columns(df)
    with pytest.raises(ValueError, match="differ"):
        driver.check_columns(df.select(*reversed(df.columns)))
    with pytest.raises(ValueError, match="keys"):
        Contract("D", driver.schema, ("Nope",)).check_columns(df)


def test_ddl(spark):
    contract = Contract.from_ddl("X", "a VARCHAR(3) NOT NULL, b INT")
    assert contract.schema["a"].dataType == T.VarcharType(3) and not contract.schema["a"].nullable


def test_key_report(spark):
    report = key_report(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["K"]).first()
    assert (report.row_count, report.key_count, report.duplicate_key_count) == (3, 2, 1)
    empty = key_report(spark.range(1).where(F.lit(False)), ["id"]).first()
    assert (empty.row_count, empty.key_count, empty.duplicate_key_count) == (0, 0, 0)


def test_information_schema(spark):
    rows = [
        (2, "Name", "nvarchar", 20, None, None, "NO"),
        (1, "Id", "int", None, 10, 0, "NO"),
        (3, "Pay", "decimal", None, 9, 2, "YES"),
        (4, "Note", "nvarchar", -1, None, None, "YES"),
        (5, "At", "datetime2", None, None, None, "YES"),
    ]
    schema = (
        "ORDINAL_POSITION int, COLUMN_NAME string, DATA_TYPE string, CHARACTER_MAXIMUM_LENGTH int, NUMERIC_PRECISION int, "
        "NUMERIC_SCALE int, IS_NULLABLE string"
    )
    contract = Contract.from_information_schema("T", spark.createDataFrame(rows, schema))
    expected = Contract.from_ddl("T", "Id INT NOT NULL, Name VARCHAR(20) NOT NULL, Pay DECIMAL(9,2), Note VARCHAR(2147483647), At TIMESTAMP")
    assert contract == expected


def test_extreme_values_are_cast_as_try_cast_does(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from tidegate.functions import safe_cast

    numbers = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,), (None,)], "v bigint")
    doubles = spark.createDataFrame([(float("nan"),), (float("-inf"),), (-99999.99,), (1e300,), (None,)], "v double")
    texts = spark.createDataFrame([("\ttrue",), ("\x7f no \n",), ("\u00a0true",), ("x",), ("",), (None,)], "v string")
    cases = [(numbers, "decimal(7,2)"), (numbers, "decimal(15,0)"), (doubles, "decimal(7,2)"), (texts, "boolean")]
    for df, kind in cases:
        target = T.StructType.fromDDL(f"v {kind}")["v"].dataType
        own, plain = df.select(
            safe_cast(F.col("v"), df.schema["v"].dataType, target).alias("a"), F.col("v").try_cast(kind).alias("b")
        ).toPandas().T.astype(str).values.tolist()
        assert own == plain, kind
