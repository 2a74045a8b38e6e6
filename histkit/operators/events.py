"""Filters, unions and latest-per-key selection over change-event tables.

Local-day filters are rewritten to ranges on the stored UTC column, so they reach the
parquet scan and prune row groups; a function on the column would block that.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.config import Interval
from histkit.functions.hashing import canonical
from histkit.functions.times import (
    DEFAULT_ZONE,
    as_datetime,
    col_of,
    column_type,
    interval_bucket,
    timestamp_literal,
    utc_of_local,
)

When = str | date | datetime
Order = Sequence[str | tuple[str, str] | Column]


def _bound(df: DataFrame, ts: str, local: datetime, zone: str) -> Column:
    return timestamp_literal(utc_of_local(local, zone), column_type(df, ts))


def _day(value: When) -> datetime:
    d = as_datetime(value)
    return datetime(d.year, d.month, d.day)


def events_by_date(
    df: DataFrame,
    start: When | None = None,
    end: When | None = None,
    ts: str = "envelopeTime",
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Local dates: both given - inclusive range; only start - that day; only end - up to that day."""
    if start is None and end is None:
        raise ValueError("give a start date, an end date or both")
    if start is not None:
        df = df.where(F.col(ts) >= _bound(df, ts, _day(start), zone))
    last = _day(end if end is not None else start)
    return df.where(F.col(ts) < _bound(df, ts, last + timedelta(days=1), zone))


def events_until(
    df: DataFrame, run_date: When, ts: str = "envelopeTime", zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Local date strictly before ``run_date``."""
    return df.where(F.col(ts) < _bound(df, ts, _day(run_date), zone))


def events_on(
    df: DataFrame, run_date: When, ts: str = "envelopeTime", zone: str = DEFAULT_ZONE
) -> DataFrame:
    return events_by_date(df, run_date, None, ts, zone)


def events_between(
    df: DataFrame, start: When, end: When, ts: str = "envelopeTime", zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Local timestamp in ``[start, end]``, closed on both ends."""
    return df.where(
        F.col(ts).between(
            _bound(df, ts, as_datetime(start), zone), _bound(df, ts, as_datetime(end), zone)
        )
    )


def events_before_delay(
    df: DataFrame, as_of: When, hours: int, ts: str = "envelopeTime", zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Local timestamp before ``as_of`` (local) minus a delay. The clock is an argument, never now()."""
    cut = as_datetime(as_of) - timedelta(hours=hours)
    return df.where(F.col(ts) < _bound(df, ts, cut, zone))


def events_in_window(
    df: DataFrame, from_ts: When | Column, to_ts: When | Column, ts: str = "envelopeTime"
) -> DataFrame:
    """Half-open UTC window; columns (such as SQL session variables) are accepted as bounds."""
    dtype = column_type(df, ts)
    lo = from_ts if isinstance(from_ts, Column) else timestamp_literal(from_ts, dtype)
    hi = to_ts if isinstance(to_ts, Column) else timestamp_literal(to_ts, dtype)
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi))


def events_since_hour(
    df: DataFrame, watermark: When | None, date_col: str = "date", hour_col: str = "hour"
) -> DataFrame:
    """Partitions from the watermark's hour on (that hour is read again); no watermark - everything.

    ``hour`` is a zero-padded string. Both conditions are on partition columns only.
    """
    if watermark is None:
        return df
    w = as_datetime(watermark)
    day = F.lit(w.date().isoformat()).cast("date")
    later = F.col(date_col) > day
    same = (F.col(date_col) == day) & (F.col(hour_col) >= F.lit(f"{w.hour:02d}"))
    return df.where((F.col(date_col) >= day) & (later | same))


def drop_test(df: DataFrame, flag: str = "isTest") -> DataFrame:
    return df.where(F.col(flag) == F.lit(False))


def require_nonblank(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.col(c) != "") for c in cols]))


def any_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """At least one of the columns or struct fields is set."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols]))


def delete_flag(type_col: str | Column, pattern: str = "Deleted") -> Column:
    """True for types containing the pattern; a missing type is not a delete."""
    return F.coalesce(col_of(type_col).contains(pattern), F.lit(False))


def with_delete_flag(
    df: DataFrame, pattern: str = "Deleted", type_col: str = "envelopeType", out: str = "is_removed"
) -> DataFrame:
    return df.withColumn(out, delete_flag(type_col, pattern))


def current_rows(
    df: DataFrame,
    flag: str | None = "is_current",
    expiry: str | None = None,
    latest: str | None = None,
    high: str = "9999-12-31",
) -> DataFrame:
    """Open versions, marked by a flag, by an open-ended expiry date, or by ``Y``."""
    if expiry is not None:
        return df.where(F.col(expiry).cast("date") == F.lit(high).cast("date"))
    return df.where(F.col(latest) == "Y") if latest is not None else df.where(F.col(flag))


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename: output name -> input column or expression."""
    return df.select(*[col_of(c).alias(out) for out, c in mapping.items()])


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union by name; a column missing on one side becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def union_verbs(
    verbs: Mapping[str, DataFrame], out: str = "is_deleted", deleted: Iterable[str] = ("deleted",)
) -> DataFrame:
    """Union one table per verb, marking the rows that come from a delete table."""
    gone = set(deleted)
    return union_all([df.withColumn(out, F.lit(verb in gone)) for verb, df in verbs.items()])


def union_distinct(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union without duplicates over whole rows, map columns included."""
    rows = union_all(dfs)
    hidden = {
        f"_c{i}": canonical(F.col(f.name), f.dataType)
        for i, f in enumerate(rows.schema.fields)
        if "map<" in f.dataType.simpleString()
    }
    if not hidden:
        return rows.distinct()
    plain = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    return rows.withColumns(hidden).dropDuplicates([*plain, *hidden]).drop(*hidden)


def key_hour_spine(dfs: Sequence[DataFrame], key: str, hour: str = "valid_from_date_hour") -> DataFrame:
    """Every (key, hour) at which any source changes."""
    return union_all([df.select(key, hour) for df in dfs]).distinct()


def sort_columns(order: Order, default: str = "desc") -> list[Column]:
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
            continue
        name, direction = (o, default) if isinstance(o, str) else o
        out.append(F.col(name).desc() if direction == "desc" else F.col(name).asc())
    return out


def top_rank(df: DataFrame, keys: Sequence[str | Column], order: Order, k: int = 1) -> DataFrame:
    """First ``k`` rows per key. Plain names sort descending; the order should break every tie.

    Spark plans this as a per-task limit before the shuffle (``WindowGroupLimit``), so one
    hot key sends at most ``k`` rows per map task to its reducer.
    """
    w = Window.partitionBy(*[col_of(c) for c in keys]).orderBy(*sort_columns(order))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def latest_per_interval(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    order: Order,
    interval: Interval = Interval.DAY,
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """The latest event of each key in each local day, hour or exact time."""
    return top_rank(df, [*keys, interval_bucket(df, ts, interval, zone)], order)


