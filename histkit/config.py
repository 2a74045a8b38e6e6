"""Job settings: plain frozen dataclasses with the defaults a job usually wants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from enum import Enum


class Interval(str, Enum):
    """How many events of a key survive: one per local day, per local hour, or per exact time."""

    DAY = "DAY"
    HOUR = "HOUR"
    EVENT = "EVENT"


# Columns of a history table that describe the row and not the entity (fixed values).
HASH_EXCLUDE = (
    "valid_from_est_timestamp",
    "valid_to_est_timestamp",
    "is_current",
    "etl_metadata_struct",
)


@dataclass(frozen=True)
class ReadSpec:
    from_tables: Mapping[str, Sequence[str]] | Sequence[str]
    source_keys: tuple[str, ...]
    order_by: tuple = ()
    job_metadata_location: str | None = None
    event_type_col: str = "envelopeType"
    create_pattern: str = "Created"
    delete_pattern: str = "Deleted"
    event_ts_col: str = "envelopeTime"
    interval: Interval = Interval.DAY
    time_delay_hours: int = 0


@dataclass(frozen=True)
class WriteSpec:
    to_table: str
    target_keys: tuple[str, ...]
    query_name: str = "history_job"
    target_order_by: tuple[str, ...] = ("source_timestamp_struct.update_est_timestamp",)
    checkpoint_location: str | None = None
    hash_exclude: tuple[str, ...] = HASH_EXCLUDE
    buckets: int = 16
    most_parts: int = 50


@dataclass(frozen=True)
class Backfill:
    """Local dates, both inclusive. A job with a backfill rebuilds its target."""

    start_date: str
    end_date: str


@dataclass(frozen=True)
class JobSpec:
    read: ReadSpec
    write: WriteSpec
    backfill: Backfill | None = None
    zone: str = "UTC-5"

    @property
    def full_reload(self) -> bool:
        return self.backfill is not None


# Names used in JSON job files -> field names here (fixed values).
_READ_NAMES = {
    "fromTables": "from_tables",
    "jobMetadataLocation": "job_metadata_location",
    "eventTypeIdentifierColumn": "event_type_col",
    "sourcePartitionKey": "source_keys",
    "orderBy": "order_by",
    "createEntityPattern": "create_pattern",
    "deleteEntityPattern": "delete_pattern",
    "eventTimestampCol": "event_ts_col",
    "latestEventIntervalType": "interval",
    "time_delay_hours": "time_delay_hours",
}
_WRITE_NAMES = {
    "toTable": "to_table",
    "targetTableUniqueKey": "target_keys",
    "targetTableOrderBy": "target_order_by",
    "checkpointLocation": "checkpoint_location",
    "queryName": "query_name",
    "targetHashExcludeColumns": "hash_exclude",
}


def _section(cls, names: Mapping[str, str], values: Mapping):
    known = {f.name for f in fields(cls)}
    kwargs = {}
    for name, value in values.items():
        target = names.get(name, name)
        if target in known and value is not None:
            kwargs[target] = tuple(value) if isinstance(value, list) else value
    if "interval" in kwargs:
        kwargs["interval"] = Interval(kwargs["interval"])
    return cls(**kwargs)


def job_spec(raw: Mapping) -> JobSpec:
    """Read a job file's dictionary; unknown sections are refused, extra options are ignored."""
    unknown = set(raw) - {"read", "write", "seqBackfillOptions", "zone"}
    if unknown:
        raise ValueError(f"unknown config sections: {sorted(unknown)}")
    backfill = raw.get("seqBackfillOptions")
    return JobSpec(
        read=_section(ReadSpec, _READ_NAMES, raw["read"]),
        write=_section(WriteSpec, _WRITE_NAMES, raw["write"]),
        backfill=Backfill(backfill["startDate"], backfill["endDate"]) if backfill else None,
        zone=raw.get("zone", "UTC-5"),
    )
