"""Local time, interval buckets and open-ended dates.

History tables keep local wall time at a fixed offset (``UTC-5`` unless told otherwise).
A fixed offset is plain interval arithmetic, so it needs no session time zone, works for
both timestamp types and keeps the order of the input. Named zones go through Spark's
``from_utc_timestamp``.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.config import Interval

DEFAULT_ZONE = "UTC-5"
OPEN_END = "9999-12-31 00:00:00"
LOW_END = "1970-01-01 00:00:00"

_OFFSET = re.compile(r"^(?:UTC|GMT)?([+-])(\d{1,2})(?::?(\d{2}))?$")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def offset_minutes(zone: str) -> int | None:
    """Minutes east of UTC, or None for a named zone."""
    if zone.upper() in ("UTC", "GMT", "Z"):
        return 0
    m = _OFFSET.match(zone)
    if not m:
        return None
    minutes = int(m.group(2)) * 60 + int(m.group(3) or 0)
    return minutes if m.group(1) == "+" else -minutes


def local_time(ts: str | Column, zone: str = DEFAULT_ZONE) -> Column:
    """UTC time -> local wall time of a timestamp column (text: see :func:`timestamp_column`)."""
    minutes = offset_minutes(zone)
    if minutes is None:
        return F.from_utc_timestamp(col_of(ts), zone)
    return col_of(ts) + F.expr(f"INTERVAL '{minutes}' MINUTE")


def column_type(df: DataFrame, ts: str | Column) -> T.DataType:
    return df.select(col_of(ts).alias("c")).schema["c"].dataType


def timestamp_column(df: DataFrame, ts: str | Column) -> Column:
    """The column as a timestamp: text is parsed, both timestamp types stay as they are."""
    text = isinstance(column_type(df, ts), T.StringType)
    return col_of(ts).cast("timestamp") if text else col_of(ts)


def trunc_hour(df: DataFrame, ts: str | Column) -> Column:
    """Start of the hour, in the type of the input."""
    return F.date_trunc("HOUR", col_of(ts)).cast(column_type(df, ts))


def interval_bucket(df: DataFrame, ts: str | Column, interval: Interval, zone: str) -> Column:
    local = local_time(timestamp_column(df, ts), zone)
    if Interval(interval) == Interval.DAY:
        return F.to_date(local)
    if Interval(interval) == Interval.HOUR:
        return F.date_trunc("HOUR", local)
    return local


def as_datetime(value: str | date | datetime) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def timestamp_literal(value: str | date | datetime, dtype: T.DataType | None = None) -> Column:
    """A UTC wall-clock literal of the wanted timestamp type (constant folded)."""
    text = as_datetime(value).replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "Z").cast("timestamp")


def utc_of_local(value: str | date | datetime, zone: str) -> datetime:
    """Local wall time -> UTC wall time, so a local-day filter becomes a range on the raw column."""
    local = as_datetime(value)
    minutes = offset_minutes(zone)
    if minutes is not None:
        return local - timedelta(minutes=minutes)
    return local.replace(tzinfo=ZoneInfo(zone)).astimezone(ZoneInfo("UTC")).replace(tzinfo=None)


def open_end(dtype: T.DataType | None = None, high: str = OPEN_END) -> Column:
    """The open-ended date as written in a history table (wall time, no zone shift)."""
    return F.lit(high).cast("timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp")
