import datetime as dt

from tidegate.operators.contracts import accepted, conform, rejected
from tidegate.plans import entities, lake
from tidegate.plans.export import payroll_export

AS_OF = dt.datetime(2024, 2, 1)


def test_non_driving_standard(spark, folder):
    spec = entities.dispatch_non_driving_standard(folder)
    spec.check("transactional")
    columns = entities.NON_DRIVING_COLUMNS.split(", ")
    contract = entities.non_driving_contract()
    assert contract.columns == columns
    day = dt.date(2024, 1, 1)
    rows = [("A", 1.0, 2.0, day, None, AS_OF, dt.datetime(2024, 1, m), "u") for m in (1, 2)]
    source = accepted(conform(spark.createDataFrame(rows, "a string, b double, c double, d date, e date, f timestamp, g timestamp, h string").toDF(*columns), contract))
    first = lake.load(spark, spec, source, "transactional", f"{folder}/ledger", AS_OF)
    again = lake.load(spark, spec, source, "transactional", f"{folder}/ledger", AS_OF)
    assert (first.row_count, first.watermark, again.status) == (1, dt.datetime(2024, 1, 2), "skipped_empty")


def test_activity_standard(folder):
    spec = entities.dispatch_activity_standard(folder, f"{folder}/second")
    spec.check("daily")
    assert not spec.incremental and spec.grain == "DAILY" and spec.current_replica.startswith(f"{folder}/second")
    assert entities.source_query("T", "a, b") == "SELECT a, b FROM dbo.T"


def test_export_meets_its_contract(spark):
    caps = spark.sql(
        "SELECT CAST(id AS DECIMAL(38,0)) AS DS_FAC_ID, DATE'2024-01-06' AS CE_WK_ENDDT, CAST(100 * id AS DECIMAL(38,0)) AS CEST_CD, "
        "CAST(3 AS DECIMAL(38,0)) AS CE_DRIVER_CNT, CAST(4 AS DECIMAL(38,0)) AS CE_TRIP_CNT, CAST(1.5 AS DECIMAL(9,2)) AS CE_TOT_PAY_MINS, "
        "CAST(NULL AS DECIMAL(9,2)) AS CE_TOP_DRIVER_MINS, TIMESTAMP'2024-01-01' AS CREATE_TS, CAST(NULL AS TIMESTAMP) AS LAST_UPD_TS, "
        "'u' AS LAST_UPD_USERID FROM VALUES (1), (2), (9) AS t(id)"
    )
    aliases = spark.sql(
        "SELECT * FROM VALUES ('a1', 1, 1, NULL), ('a2', 1, 1, 0), ('b', 2, NULL, 0), ('c', 2, 1, 1) "
        "AS t(FACILITY_ALIAS_ID, FACILITY_ID, IS_PRIMARY, MARK_FOR_DELETION)"
    )
    checked = conform(payroll_export(caps, aliases), entities.export_contract())
    assert sorted((r.DispatchAlias, r.Status) for r in accepted(checked).collect()) == [("a1", "SentToCAPs"), ("a2", "SentToCAPs")]
    assert [r.reasons for r in rejected(checked).collect()] == ["DispatchAlias: missing"] * 2
