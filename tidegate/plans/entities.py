"""The two fully specified lake entities, and a target contract for each shape that needs one."""

from __future__ import annotations

from tidegate.operators.contracts import Contract
from tidegate.plans.specs import LakeEntity

# Source columns in select order.
NON_DRIVING_COLUMNS = (
    "DispatchAlias, BeginDayMinutes, EndDayMinutes, EffectiveStartDate, EffectiveEndDate, CreatedDateTime, UpdatedDateTime, "
    "UpdatedUserID"
)
ACTIVITY_COLUMNS = (
    "DispatchActivityStandardID, DispatchAlias, ProductCategoryID, ReceivingTypeID, DeliveryUnitTypeID, PreStop, PostStop, Unload, "
    "Reload, EffectiveStartDate, EffectiveEndDate, CreatedDateTime, UpdatedDateTime, UpdatedUserID"
)

# Columns of the payroll export's target table.
EXPORT_DDL = (
    "DispatchAlias VARCHAR(50) NOT NULL, WeekEndDate DATE NOT NULL, Status VARCHAR(50) NOT NULL, DriverCount INT, TripCount INT, "
    "TotalPayMinutes DECIMAL(9,2), TopDriverMinutes DECIMAL(9,2), CreatedDateTime TIMESTAMP NOT NULL, "
    "UpdatedDateTime TIMESTAMP NOT NULL, UpdatedUserID VARCHAR(10) NOT NULL"
)
# Columns of the non-driving standard's target table.
NON_DRIVING_DDL = (
    "DispatchAlias VARCHAR(50) NOT NULL, BeginDayMinutes DECIMAL(9,2) NOT NULL, EndDayMinutes DECIMAL(9,2) NOT NULL, "
    "EffectiveStartDate DATE NOT NULL, EffectiveEndDate DATE, CreatedDateTime TIMESTAMP NOT NULL, UpdatedDateTime TIMESTAMP, "
    "UpdatedUserID VARCHAR(50)"
)


def source_query(table: str, columns: str) -> str:
    return f"SELECT {columns} FROM dbo.{table}"


def _lake_entity(name: str, root: str, replica: str | None, **settings) -> LakeEntity:
    return LakeEntity(
        name=name,
        keys=["DispatchAlias"],
        raw_path=f"{root}/Raw/{name}",
        current_path=f"{root}/Transform/{name}",
        raw_replica=replica and f"{replica}/Raw/{name}",
        current_replica=replica and f"{replica}/Transform/{name}",
        watermark="UpdatedDateTime",
        **settings,
    )


def dispatch_non_driving_standard(root: str, replica: str | None = None) -> LakeEntity:
    """Loaded hourly by increments that are merged into raw and current state."""
    return _lake_entity("DispatchNonDrivingStandard", root, replica, incremental=True, grain="HOURLY", raw_merge=True)


def dispatch_activity_standard(root: str, replica: str | None = None) -> LakeEntity:
    """Loaded whole every day. Its key is the dispatch alias, so one row per alias remains."""
    return _lake_entity("DispatchActivityStandard", root, replica, grain="DAILY")


def export_contract() -> Contract:
    return Contract.from_ddl("CapsExport", EXPORT_DDL)


def non_driving_contract() -> Contract:
    return Contract.from_ddl("DispatchNonDrivingStandard", NON_DRIVING_DDL, ["DispatchAlias"])
