"""Type-2 history: keep real changes, derive validity, apply deletes, compare with a target."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.config import HASH_EXCLUDE, Interval, JobSpec
from histkit.functions.hashing import comparable, hash_expr
from histkit.functions.times import (
    DEFAULT_ZONE,
    LOW_END,
    OPEN_END,
    column_type,
    local_time,
    open_end,
    timestamp_column,
    timestamp_literal,
    trunc_hour,
)
from histkit.operators import events as ev
from histkit.operators.windows import HOT_ROWS, next_value, previous_value


@dataclass(frozen=True)
class Scd2Columns:
    """Names of the validity columns and the open-ended date of a history table."""

    valid_from: str = "valid_from_est_timestamp"
    valid_to: str = "valid_to_est_timestamp"
    is_current: str = "is_current"
    audit: str = "etl_metadata_struct"
    high: str = OPEN_END

    @property
    def deleted(self) -> str:
        return f"{self.audit}.is_deleted"


DEFAULT_COLUMNS = Scd2Columns()


def audit_struct(
    df: DataFrame,
    as_of: str | datetime,
    zone: str = DEFAULT_ZONE,
    delete_pattern: str | None = None,
    type_col: str = "envelopeType",
    out: str = "etl_metadata_struct",
) -> DataFrame:
    """Batch times (UTC ``as_of`` in local time) and, with a pattern, the delete flag."""
    local = local_time(timestamp_literal(as_of), zone)
    fields = [local.alias("etl_create_est_timestamp"), local.alias("etl_update_est_timestamp")]
    if delete_pattern is not None:
        fields.append(ev.delete_flag(type_col, delete_pattern).alias("is_deleted"))
    return df.withColumn(out, F.struct(*fields))


def source_timestamps(
    df: DataFrame,
    create_col: str | Column,
    update_col: str | Column,
    zone: str = DEFAULT_ZONE,
    out: str = "source_timestamp_struct",
) -> DataFrame:
    return df.withColumn(
        out,
        F.struct(
            local_time(timestamp_column(df, create_col), zone).alias("create_est_timestamp"),
            local_time(timestamp_column(df, update_col), zone).alias("update_est_timestamp"),
        ),
    )


# Fields of the request context, in output order (fixed values).
_CONTEXT = {
    "deviceId": "device_id",
    "sessionId": "session_id",
    "tokenId": "token_id",
    "actionId": "action_id",
    "identityId": "identity_id",
    "accountId": "account_id",
    "profileId": "profile_id",
    "agentId": "agent_id",
}


def request_context(df: DataFrame, source: str = "requestContext", out: str = "request_context_struct") -> DataFrame:
    """Flat request context: renamed ids and the logical clock as it is."""
    ids = [F.col(f"{source}.{n}").alias(o) for n, o in _CONTEXT.items()]
    return df.withColumn(out, F.struct(*ids, F.col(f"{source}.logicalClock").alias("logical_clock")))


def request_context_nested(df: DataFrame, source: str = "requestContext", out: str = "request_context") -> DataFrame:
    """Request context with its origin (agent, user or system action) and clock as nested structs."""

    def part(path: str, **fields: str) -> Column:
        return F.struct(*[F.col(f"{source}.{path}.{f}").alias(o) for o, f in fields.items()])

    origin = F.struct(
        part("origin.internalAgentAction", agent_id="agentId").alias("internal_agent_action"),
        part("origin.internalUserAction", _="_").alias("internal_user_action"),
        part(
            "origin.internalSystemAction", system_name="systemName", description="description"
        ).alias("internal_system_action"),
    )
    ids = [F.col(f"{source}.{n}").alias(o) for n, o in _CONTEXT.items()]
    clock = part("logicalClock", epoch="epoch", counter="counter")
    return df.withColumn(out, F.struct(origin.alias("origin"), *ids, clock.alias("logical_clock")))


def seed_scd2(
    df: DataFrame,
    ts: str | Column | None = None,
    zone: str = DEFAULT_ZONE,
    cols: Scd2Columns = DEFAULT_COLUMNS,
) -> DataFrame:
    """Add the validity columns: start from the event time when given, the rest typed nulls."""
    dtype = column_type(df, timestamp_column(df, ts)) if ts is not None else T.TimestampType()
    start = local_time(timestamp_column(df, ts), zone) if ts is not None else F.lit(None).cast(dtype)
    return df.withColumns(
        {
            cols.valid_from: start,
            cols.valid_to: F.lit(None).cast(dtype),
            cols.is_current: F.lit(None).cast("boolean"),
        }
    )


def drop_sequential_unchanged(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str] | None = None,
    exclude: Iterable[str] = HASH_EXCLUDE,
    deleted: str | None = None,
    slice_by: str | Column | None = None,
    compat: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Keep a row when it differs from the row before it in its key.

    Compared are the tracked columns, or a hash of all columns but ``exclude``. With
    ``deleted`` the flag takes part in the comparison (so a re-creation is a change) and
    every delete is kept.
    """
    if tracked is not None:
        parts = [c.alias(f"c{i}") for i, c in enumerate(comparable(df, tracked))]
    else:
        parts = [hash_expr(df, exclude, compat).alias("h")]
    gone = F.lit(False)
    if deleted is not None:
        gone = F.coalesce(F.col(deleted), F.lit(False))
        parts.append(gone.alias("d"))
    state = F.struct(*parts)
    rows = previous_value(df.withColumn("_state", state), keys, order, "_state", "_before", slice_by, hot_rows)
    changed = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("_state"))
    return rows.where(changed | gone).drop("_state", "_before")


def ignore_unchanged_vs_target(
    src: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    exclude: Iterable[str] = HASH_EXCLUDE,
    cols: Scd2Columns = DEFAULT_COLUMNS,
) -> DataFrame:
    """Source rows that are new or differ from the current target row of their key.

    Only current rows count, so a key that was closed and comes back is new again.
    """
    skip = [*exclude, *keys]
    shared = [c for c in src.columns if c in target.columns]
    current = (
        target.where(F.col(cols.is_current))
        .select(*shared)
        .select(*keys, hash_expr(target.select(*shared), skip).alias("_target_hash"))
    )
    mine = src.withColumn("_source_hash", hash_expr(src.select(*shared), skip))
    return (
        mine.join(current, list(keys), "left")
        .where(~F.col("_source_hash").eqNullSafe(F.col("_target_hash")))
        .select(*src.columns)
    )


def _newest_start(src: DataFrame, target: DataFrame, keys: Sequence[str], cols: Scd2Columns) -> DataFrame:
    """Newest stored start of each key of the batch, over closed rows too."""
    stored = target.select(*keys, cols.valid_from).join(src.select(*keys).distinct(), list(keys), "left_semi")
    return stored.groupBy(*keys).agg(F.max(cols.valid_from).alias("_newest"))


def consolidate(
    src: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    full_reload: bool = False,
    cols: Scd2Columns = DEFAULT_COLUMNS,
    all_current: bool = False,
) -> DataFrame:
    """Events newer than anything stored for their key, plus the current target rows of those keys.

    The newest start per key is taken over all target rows, closed ones included, so a key
    that ends in a tombstone does not accept the same batch twice. A key that is not stored
    keeps all its events. Events that are not newer are left to :func:`late_events`.
    ``all_current`` adds the current rows of all keys instead, which costs the whole target.
    """
    if full_reload:
        return src
    newest = _newest_start(src, target, keys, cols)
    fresh = (
        src.join(newest, list(keys), "left")
        .where(F.col("_newest").isNull() | (F.col(cols.valid_from) > F.col("_newest")))
        .select(*src.columns)
    )
    current = target.where(F.col(cols.is_current))
    if not all_current:
        current = current.join(src.select(*keys).distinct(), list(keys), "left_semi").select(*target.columns)
    return fresh.unionByName(current, allowMissingColumns=False)


def late_events(src: DataFrame, target: DataFrame, keys: Sequence[str], cols: Scd2Columns = DEFAULT_COLUMNS) -> DataFrame:
    """Events that :func:`consolidate` leaves out: not after the newest stored start of their
    key, or without a start. Store them, count them, or rebuild their keys."""
    start = F.col(cols.valid_from)
    known = src.join(_newest_start(src, target, keys, cols), list(keys))
    return known.where(start.isNull() | (start <= F.col("_newest"))).select(*src.columns)


def build_validity(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    cols: Scd2Columns = DEFAULT_COLUMNS,
    slice_by: str | Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """End of validity = start of the key's next row; the last row stays open and is current."""
    dtype = df.schema[cols.valid_from].dataType
    rows = next_value(
        df.drop(cols.valid_to, cols.is_current),
        keys,
        order or [cols.valid_from],
        cols.valid_from,
        cols.valid_to,
        slice_by,
        hot_rows,
    )
    high = open_end(dtype, cols.high)
    rows = rows.withColumn(cols.valid_to, F.coalesce(F.col(cols.valid_to), high))
    rows = rows.withColumn(cols.is_current, F.col(cols.valid_to) == high)
    return rows.select(*df.columns, *[c for c in (cols.valid_to, cols.is_current) if c not in df.columns])


def apply_deletes(
    df: DataFrame, deleted: str | None = None, cols: Scd2Columns = DEFAULT_COLUMNS
) -> DataFrame:
    """A delete row becomes a tombstone of zero length that is never current."""
    gone = F.coalesce(F.col(deleted or cols.deleted), F.lit(False))
    return df.withColumns(
        {
            cols.is_current: F.when(gone, F.lit(False)).otherwise(F.col(cols.is_current)),
            cols.valid_to: F.when(gone, F.col(cols.valid_from)).otherwise(F.col(cols.valid_to)),
        }
    )


def scd2_changes(
    events: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    exclude: Iterable[str] = HASH_EXCLUDE,
    full_reload: bool = False,
    deleted: str | None = None,
    cols: Scd2Columns = DEFAULT_COLUMNS,
    slice_by: str | Column | None = None,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Projected events -> rows ready to merge into (or to replace) a type-2 target.

    Cut windows read their input twice. ``store`` (such as
    :func:`histkit.sources.files.materialize`) writes that input once instead of having it
    computed again; it is only used together with ``slice_by``.
    """
    by = list(order or [cols.valid_from])
    keep = store if store is not None and slice_by is not None else lambda df, name: df
    rows = events if target is None else consolidate(events, target, keys, full_reload, cols)
    rows = keep(rows, "events")
    rows = drop_sequential_unchanged(rows, keys, by, None, exclude, deleted, slice_by, hot_rows=hot_rows)
    rows = build_validity(keep(rows, "changes"), keys, by, cols, slice_by, hot_rows)
    return apply_deletes(rows, deleted, cols) if deleted else rows


def scd2_pipeline(
    events: DataFrame,
    target: DataFrame | None,
    spec: JobSpec,
    as_of: str | datetime,
    project=None,
    valid_from_ts: str | None = None,
    source_ts: tuple[str, str] | None = None,
    cols: Scd2Columns = DEFAULT_COLUMNS,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """From raw events of all verbs to rows for the target table: :func:`projected_events`, then :func:`scd2_delta`."""
    rows = projected_events(events, spec, as_of, project, valid_from_ts, source_ts, cols)
    return scd2_delta(rows, target, spec, cols, store, hot_rows)


def projected_events(
    events: DataFrame,
    spec: JobSpec,
    as_of: str | datetime,
    project=None,
    valid_from_ts: str | None = None,
    source_ts: tuple[str, str] | None = None,
    cols: Scd2Columns = DEFAULT_COLUMNS,
) -> DataFrame:
    """Latest event per key and interval (delete flag available for the order), audit struct,
    validity columns, and the entity's own ``project`` function."""
    read, zone = spec.read, spec.zone
    rows = audit_struct(events, as_of, zone, read.delete_pattern, read.event_type_col, cols.audit)
    order = read.order_by or (read.event_ts_col,)
    rows = ev.latest_per_interval(rows, read.event_ts_col, read.source_keys, order, read.interval, zone)
    rows = seed_scd2(rows, valid_from_ts or read.event_ts_col, zone, cols)
    if source_ts is not None:
        rows = source_timestamps(rows, *source_ts, zone)
    return project(rows) if project is not None else rows


def scd2_delta(
    rows: DataFrame,
    target: DataFrame | None,
    spec: JobSpec,
    cols: Scd2Columns = DEFAULT_COLUMNS,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Changes of projected events against the target, or a whole history without one."""
    read = spec.read
    if target is not None:
        rows = rows.select(*target.columns)
    # One row per local day or hour bounds a key; exact times do not, so cut hot keys by minute.
    slice_by = F.date_trunc("MINUTE", F.col(cols.valid_from)) if read.interval == Interval.EVENT else None
    order_by = [cols.valid_from]
    if slice_by is None:
        known = [c for c in spec.write.target_order_by if c.split(".")[0] in rows.columns]
        order_by = [*known, *[c for c in order_by if c not in known]]
    return scd2_changes(
        rows,
        target,
        spec.write.target_keys,
        order_by,
        spec.write.hash_exclude,
        spec.full_reload,
        cols.deleted,
        cols,
        slice_by,
        store,
        hot_rows,
    )


def scd_stage(
    df: DataFrame,
    key: str,
    tracked: Sequence[str],
    order: ev.Order,
    ts: str = "envelopeTime",
    deleted: str = "is_deleted",
    zone: str = DEFAULT_ZONE,
    keep: Sequence[str] = (),
    high: str = OPEN_END,
) -> DataFrame:
    """Hourly staging history of one entity: one row per key and hour in which it changed.

    Latest event per (key, local hour), then rows equal to the one before are dropped
    (deletes stay), then the end of validity is the next row's hour.
    """
    return stage_of_hours(hourly_rows(df, key, tracked, order, ts, deleted, zone, keep), key, tracked, high)


def hourly_rows(
    df: DataFrame,
    key: str,
    tracked: Sequence[str],
    order: ev.Order,
    ts: str = "envelopeTime",
    deleted: str = "is_deleted",
    zone: str = DEFAULT_ZONE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The latest event per key and local hour, changed or not."""
    rows = df.withColumn("valid_from_date_hour", trunc_hour(df, local_time(ts, zone)))
    rows = ev.top_rank(rows, [key, "valid_from_date_hour"], order)
    payload = [c for c in tracked if c != key]
    return rows.select(key, *payload, *keep, "valid_from_date_hour", F.col(deleted).alias("is_deleted"))


def stage_of_hours(rows: DataFrame, key: str, tracked: Sequence[str], high: str = OPEN_END) -> DataFrame:
    """The staging history of hourly rows."""
    by = ["valid_from_date_hour"]
    payload = [c for c in rows.columns if c not in (key, "is_deleted", *by)]
    rows = drop_sequential_unchanged(rows, [key], by, tracked, (), "is_deleted")
    rows = next_value(rows, [key], by, F.col(by[0]), "valid_to_date_hour")
    end = open_end(rows.schema[by[0]].dataType, high)
    to = F.coalesce(F.col("valid_to_date_hour"), end)
    return rows.select(
        key,
        *payload,
        *by,
        to.alias("valid_to_date_hour"),
        (~F.col("is_deleted") & (to == end)).alias("is_current"),
        "is_deleted",
    )
