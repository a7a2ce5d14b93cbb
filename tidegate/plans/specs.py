"""What a load needs to know about an entity, checked before anything is written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidegate.sinks.tables import BUCKET_BYTES

GRAINS = ("HOURLY", "DAILY")
MODES = ("daily", "transactional", "historical", "initial")

# Columns that tell which of two rows of a key is newer.
DEFAULT_ORDER = ("UpdatedDateTime", "CreatedDateTime")

Transform = str | Callable[[DataFrame], DataFrame] | None


@dataclass(frozen=True)
class LakeEntity:
    """A table loaded into the lake: its keys, its change column and where its copies live."""

    name: str
    keys: Sequence[str]
    raw_path: str
    current_path: str
    order: Sequence[str] = DEFAULT_ORDER
    dedupe_keys: Sequence[str] | None = None
    watermark: str | None = None
    incremental: bool = False
    grain: str | None = None
    raw_merge: bool = False
    raw_replica: str | None = None
    current_replica: str | None = None
    transform: Transform = None
    ledger_name: str | None = None
    lookback: dt.timedelta = dt.timedelta(0)
    buckets: int | None = None
    bucket_bytes: int = BUCKET_BYTES
    write_enabled: bool = True
    append_daily: bool = False

    def grain_for(self, mode: str) -> str:
        return (self.grain or ("HOURLY" if mode == "transactional" else "DAILY")).upper()

    def is_incremental(self, mode: str) -> bool:
        """Only a transactional load is incremental; other modes ignore the setting."""
        return self.incremental and mode == "transactional"

    def check(self, mode: str) -> None:
        if mode not in MODES:
            raise ValueError(f"{self.name}: unsupported load mode '{mode}', expected one of {MODES}")
        if not self.write_enabled:
            raise ValueError(f"{self.name}: writing is disabled")
        if not self.keys:
            raise ValueError(f"{self.name}: a load needs at least one key")
        grain = self.grain_for(mode)
        if grain not in GRAINS:
            raise ValueError(f"{self.name}: unsupported grain '{grain}', expected one of {GRAINS}")
        if self.is_incremental(mode):
            if not self.watermark:
                raise ValueError(f"{self.name}: an incremental load needs a watermark column")
            if grain == "DAILY" and not self.append_daily:
                raise ValueError(f"{self.name}: an increment must not overwrite a daily table")


@dataclass(frozen=True)
class DatabaseEntity:
    """A table loaded into a database."""

    name: str
    table: str
    write_mode: str
    dedupe_keys: Sequence[str] = ()
    watermark: str | None = None
    incremental: bool = False
    transform: Transform = None
    excluded_columns: Sequence[str] = ()
    suffix_columns: tuple[str, str] | None = None
    chunk_column: str | None = None
    chunks: int = 1
    history_column: str | None = None
    keep_history_on_initial: bool = False
    ledger_name: str | None = None
    lookback: dt.timedelta = dt.timedelta(0)
    options: Mapping[str, object] = field(default_factory=dict)
    write_enabled: bool = False

    def is_incremental(self, mode: str) -> bool:
        return self.incremental and mode == "transactional"

    def check(self, mode: str) -> None:
        if mode not in MODES:
            raise ValueError(f"{self.name}: unsupported load mode '{mode}', expected one of {MODES}")
        if self.write_mode not in ("append", "truncate_insert"):
            raise ValueError(f"{self.name}: unsupported write mode '{self.write_mode}'")
        if not self.table:
            raise ValueError(f"{self.name}: no target table")
        if self.chunks > 1 and not self.chunk_column:
            raise ValueError(f"{self.name}: writing in chunks needs a column")
        if self.is_incremental(mode):
            if not self.watermark:
                raise ValueError(f"{self.name}: an incremental load needs a watermark column")
            if self.write_mode == "append" and not self.dedupe_keys:
                raise ValueError(f"{self.name}: appending increments needs dedupe keys, or a replay repeats rows")


@dataclass(frozen=True)
class LoadResult:
    entity_name: str
    status: str
    row_count: int = 0
    raw_mode: str = ""
    current_mode: str = ""
    watermark: dt.datetime | None = None
    touched: Sequence[int] | None = None
