"""Watermarks: how far a job has read, kept as a one-row table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from histkit.functions.times import timestamp_literal
from histkit.operators.events import union_all
from histkit.sources.files import path_exists

COLUMN = "processTimestamp"


def read_watermark(spark: SparkSession, path: str | None, required: bool = False) -> datetime | None:
    """The stored time (UTC wall time), or None when nothing was stored yet."""
    row = None
    if path is not None and path_exists(spark, path):
        row = spark.read.parquet(path).select(F.col(COLUMN).cast("timestamp_ntz")).first()
    if row is None and required:
        raise LookupError(f"no watermark at {path}")
    return row[0] if row else None


def write_watermark(
    spark: SparkSession, path: str, processed: datetime | None, fallback: datetime | None = None
) -> None:
    """Replace the stored time. Call it after the target was written."""
    value = processed if processed is not None else fallback
    if value is None:
        raise ValueError("neither a processed time nor a fallback was given")
    text = F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    spark.range(1).select(text.alias(COLUMN)).coalesce(1).write.mode("overwrite").parquet(path)


def loaded_watermark(df: DataFrame, col: str) -> DataFrame:
    """One row with the newest loaded value."""
    return df.agg(F.max(col).alias(COLUMN))


def advance_watermark(df: DataFrame, col: str, path: str) -> datetime | None:
    """Store the newest loaded value; an empty load leaves the watermark alone."""
    value = loaded_watermark(df, col).select(F.col(COLUMN).cast("timestamp_ntz")).first()[0]
    if value is not None:
        write_watermark(df.sparkSession, path, value)
    return value


def observed_maximum(df: DataFrame, col: str) -> tuple[DataFrame, Observation]:
    """The rows, and an observation of their newest value made while they are read by the next action.

    Unlike a second read after the load, this cannot see rows that arrived in the meantime and
    were not loaded: a live source loses nothing. The action must read all rows, as a write does.
    """
    seen = Observation(f"watermark-{uuid.uuid4().hex}")
    return df.observe(seen, F.max(F.col(col)).cast("timestamp_ntz").cast("string").alias(COLUMN)), seen


def store_observed(spark: SparkSession, seen: Observation, path: str) -> datetime | None:
    """Store what was observed; an empty load leaves the watermark alone."""
    text = seen.get.get(COLUMN)
    if text is None:
        return None
    value = datetime.fromisoformat(text)
    write_watermark(spark, path, value)
    return value


def newer_than(df: DataFrame, col: str, watermark: datetime | str) -> DataFrame:
    """Strictly newer than the watermark; pushed down to files and JDBC sources."""
    return df.where(F.col(col) > timestamp_literal(watermark, df.schema[col].dataType))


def low_watermark(
    dfs: Sequence[DataFrame], date_col: str = "date", hour_col: str = "hour", out: str = "low_watermark"
) -> DataFrame:
    """The hour up to which every source has data: the smallest of the sources' newest hours."""
    newest = [
        df.agg(F.max(F.concat(F.col(date_col).cast("string"), F.lit("-"), F.col(hour_col))).alias("h"))
        for df in dfs
    ]
    return union_all(newest).agg(F.to_timestamp(F.min("h"), "yyyy-MM-dd-HH").alias(out))


def process_window(
    control: DataFrame,
    audit: DataFrame,
    config: DataFrame,
    dept: str,
    division: str,
    subject: str,
    status: str = "IN PROGRESS",
) -> DataFrame:
    """From and to date (as text) of the running load of one subject area."""
    area = config.where(
        (F.upper("dept_nm") == dept.upper())
        & (F.upper("division_nm") == division.upper())
        & (F.upper("subject_area_nm") == subject.upper())
    ).select("subject_area_id")
    running = control.where(
        (F.col("subject_area_id") == area.scalar()) & (F.upper("process_status_cd") == status.upper())
    )

    def day(c: str):
        return F.col(c).cast("date").cast("string")

    return running.join(audit.select("subject_area_id", "batch_start_ts"), "subject_area_id").select(
        day("start_exec_ts").alias("from_date"),
        F.coalesce(day("end_exec_ts"), day("batch_start_ts")).alias("to_date"),
    )
