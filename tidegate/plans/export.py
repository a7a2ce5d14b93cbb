"""The payroll export: pay totals per facility and week with the facility's alias and a status name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions import EXPORT_STATUS, decode, effective_change_time, primary_alias


def primary_aliases(aliases: DataFrame) -> DataFrame:
    """Aliases that are primary and not marked for deletion."""
    kept = aliases.where(primary_alias())
    return kept.select("FACILITY_ALIAS_ID", F.col("FACILITY_ID").cast("decimal(38,0)").alias("FACILITY_ID"))


def payroll_export(caps: DataFrame, aliases: DataFrame) -> DataFrame:
    """Target rows. A facility without a primary alias keeps its row with a NULL alias; one with
    several gets a row for each."""
    alias = primary_aliases(aliases)
    facility = F.col("DS_FAC_ID").cast("decimal(38,0)")
    joined = caps.join(alias, facility == F.col("FACILITY_ID"), "left")
    return joined.select(
        F.col("FACILITY_ALIAS_ID").cast("string").alias("DispatchAlias"),
        F.col("CE_WK_ENDDT").alias("WeekEndDate"),
        decode("CEST_CD", EXPORT_STATUS).alias("Status"),
        F.col("CE_DRIVER_CNT").cast("int").alias("DriverCount"),
        F.col("CE_TRIP_CNT").cast("int").alias("TripCount"),
        F.col("CE_TOT_PAY_MINS").cast("decimal(9,2)").alias("TotalPayMinutes"),
        F.col("CE_TOP_DRIVER_MINS").cast("decimal(9,2)").alias("TopDriverMinutes"),
        F.col("CREATE_TS").alias("CreatedDateTime"),
        effective_change_time("LAST_UPD_TS", "CREATE_TS").alias("UpdatedDateTime"),
        F.col("LAST_UPD_USERID").cast("string").alias("UpdatedUserID"),
    )
