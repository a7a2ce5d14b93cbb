import datetime as dt

import pytest

from tidegate.functions import EPOCH
from tidegate.sinks import ledger

D = dt.datetime(2024, 1, 1, 10)


def test_latest_complete_load_counts(spark, folder):
    path = f"{folder}/ledger"
    assert ledger.last_watermark(spark, path, "a") == EPOCH
    ledger.append(spark, path, "a", 5, D, D)
    ledger.append(spark, path, "a", 5, D + dt.timedelta(hours=1), D, complete=False)
    ledger.append(spark, path, "b", 5, D + dt.timedelta(hours=2), D)
    assert ledger.last_watermark(spark, path, "a") == D
    assert not ledger.append(spark, path, "a", 5, None, D)
    assert ledger.read(spark, path).count() == 3


def test_microseconds_are_kept(spark, folder):
    stamp = D + dt.timedelta(microseconds=123456)
    ledger.append(spark, f"{folder}/ledger", "a", 3_000_000_000, stamp, D)
    assert ledger.last_watermark(spark, f"{folder}/ledger", "a") == stamp
    assert ledger.read(spark, f"{folder}/ledger").first().ROW_COUNT == 3_000_000_000


def test_fallback_to_the_table(spark, folder):
    table = spark.createDataFrame([("2024-03-01 00:00:00.000001",), (None,)], "changed string")
    found = ledger.last_watermark(spark, f"{folder}/none", "a", table, "CHANGED")
    assert found == dt.datetime(2024, 3, 1, 0, 0, 0, 1)
    assert ledger.last_watermark(spark, f"{folder}/none", "a", table.limit(0), "changed") == EPOCH


def test_a_broken_ledger_is_an_error(spark, folder):
    spark.createDataFrame([("not a ledger",)], "value string").write.text(f"{folder}/ledger")
    with pytest.raises(Exception):
        ledger.last_watermark(spark, f"{folder}/ledger", "a")


def test_names():
    assert ledger.ledger_name("E") == "E"
    assert ledger.ledger_name("E", None, " D ") == "D"
    assert ledger.ledger_name("E", "C", "D") == "C"
