"""A type-2 dimension job: read, filter, build history, then replace or merge the target."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histkit.config import JobSpec
from histkit.functions.times import local_time, timestamp_literal
from histkit.operators import events as ev
from histkit.operators.merge import merge_scd2, merged_rows
from histkit.operators.scd2 import DEFAULT_COLUMNS, Scd2Columns, projected_events, scd2_delta
from histkit.operators.windows import HOT_ROWS
from histkit.sources.files import append_history, compact_history, materialize, read_buckets_of, read_open, read_tables, write_history
from histkit.sources.watermark import observed_maximum, read_watermark, store_observed


def source_events(
    spark: SparkSession, spec: JobSpec, name: str | None = None, run_date: str | None = None, as_of: str | datetime | None = None
) -> DataFrame:
    """Events of a run: the backfill's dates, one local day, up to a delay, or new hours since the watermark."""
    read, zone = spec.read, spec.zone
    if spec.backfill is not None:
        b = spec.backfill
        return read_tables(
            spark, read.from_tables, name, lambda df: ev.events_by_date(df, b.start_date, b.end_date, read.event_ts_col, zone)
        )
    if run_date is not None:
        return read_tables(
            spark, read.from_tables, name, lambda df: ev.events_by_date(df, run_date, None, read.event_ts_col, zone)
        )
    if read.time_delay_hours:
        return read_tables(
            spark,
            read.from_tables,
            name,
            lambda df: ev.events_before_delay(df, as_of, read.time_delay_hours, read.event_ts_col, zone),
        )
    since = read_watermark(spark, read.job_metadata_location)
    return read_tables(spark, read.from_tables, name, lambda df: ev.events_since_hour(df, since))


def run_history_job(
    spark: SparkSession,
    spec: JobSpec,
    events: DataFrame,
    version: int,
    as_of: str | datetime,
    project: Callable[[DataFrame], DataFrame],
    first_load: bool = False,
    cols: Scd2Columns = DEFAULT_COLUMNS,
    store: Callable[[DataFrame, str], DataFrame] = materialize,
    hot_rows: int = HOT_ROWS,
    **projection,
) -> None:
    """Write version ``version`` of the target under ``to_table``; a repeated run replaces it.

    A backfill or first load replaces the target; otherwise the batch is merged into the
    newest earlier version. The events are read once: their projection is stored, and the
    watermark is observed on the rows that were read for it. A delta load reads the closed rows of the buckets
    of its keys only, for their newest start, and never writes closed rows again: it writes the open rows and
    those it closes. A target of more than ``most_parts`` parts is written as one again. The watermark moves only
    after the target was written.
    """
    base, keys = spec.write.to_table, spec.write.target_keys
    is_open = F.col(cols.is_current)
    events, seen = observed_maximum(events, spec.read.event_ts_col)
    batch = store(projected_events(events, spec, as_of, project, cols=cols, **projection), "batch")
    if spec.full_reload or first_load:
        write_history(scd2_delta(batch, None, spec, cols, store, hot_rows), base, version, is_open, keys, spec.write.buckets)
    else:
        target = read_buckets_of(batch, base, keys, before=version)
        # A merge reads its source several times, so the batch's rows are stored first.
        delta = store(scd2_delta(batch, target, spec, cols, store, hot_rows), "delta")
        now = local_time(timestamp_literal(as_of), spec.zone)
        live = read_open(spark, base, before=version)
        rows = merged_rows(merge_scd2(live, delta, keys, now, cols, source_unique=True))
        append_history(rows, base, version, is_open, keys)
        compact_history(spark, base, keys, is_open, spec.write.most_parts)
    if spec.read.job_metadata_location is not None:
        store_observed(spark, seen, spec.read.job_metadata_location)
