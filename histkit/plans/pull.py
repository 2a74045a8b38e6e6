"""Load of an hourly export: deduplicate, check, conform, upsert changes, advance the watermark."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from histkit.functions.casts import conform
from histkit.operators.events import top_rank
from histkit.operators.merge import merged_rows, new_and_updated, upsert_replace
from histkit.operators.quality import require_unique
from histkit.operators.scd2 import audit_struct
from histkit.sources.buckets import BucketTable
from histkit.sources.files import materialize, read_hour, read_snapshot, write_snapshot
from histkit.sources.watermark import observed_maximum, store_observed


def export_updates(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    as_of: str | datetime,
    dedup_ascending: Mapping[str, bool] | None = None,
) -> DataFrame:
    """Rows of an export that are new or changed, in the target's schema.

    ``dedup_ascending``: order columns -> ascending?; the first row per key is kept.
    """
    if dedup_ascending:
        order = [(c, "asc" if up else "desc") for c, up in dedup_ascending.items()]
        source = top_rank(source, keys, order)
    rows = audit_struct(require_unique(source, keys), as_of)
    schema = target.schema
    if "etl_metadata_struct" not in target.columns:
        rows = rows.drop("etl_metadata_struct")
    return new_and_updated(conform(rows, schema), target, keys)


def run_pull(
    spark: SparkSession,
    export_base: str,
    target_base: str,
    keys: Sequence[str],
    run_ts: datetime | str,
    version: int,
    process_ts_col: str | None = None,
    watermark_path: str | None = None,
    dedup_ascending: Mapping[str, bool] | None = None,
) -> None:
    """Pull one hour into a new version of a whole table. For big targets see :func:`run_bucket_pull`."""
    source, seen = _stored_hour(spark, export_base, run_ts, process_ts_col)
    target = read_snapshot(spark, target_base, before=version)
    updates = export_updates(source, target, keys, run_ts, dedup_ascending)
    write_snapshot(merged_rows(upsert_replace(target, updates, keys)), target_base, version)
    if seen is not None and watermark_path:
        store_observed(spark, seen, watermark_path)


def run_bucket_pull(
    spark: SparkSession,
    export_base: str,
    target: BucketTable,
    run_ts: datetime | str,
    process_ts_col: str | None = None,
    watermark_path: str | None = None,
    dedup_ascending: Mapping[str, bool] | None = None,
) -> None:
    """Pull one hour and write its changes: only the buckets of the export's keys are read, and only
    those with a new or changed row are written again. A repeated pull finds no change and writes nothing."""
    source, seen = _stored_hour(spark, export_base, run_ts, process_ts_col)
    keys = list(target.keys)
    updates = materialize(export_updates(source, target.of_keys(source), keys, run_ts, dedup_ascending), "updates")
    target.replace(updates.select(*keys), updates)
    if seen is not None and watermark_path:
        store_observed(spark, seen, watermark_path)


def _stored_hour(spark: SparkSession, export_base: str, run_ts: datetime | str, process_ts_col: str | None):
    """The hour's rows, read once, and the newest process time among the rows read."""
    source, seen = read_hour(spark, export_base, run_ts), None
    if process_ts_col:
        source, seen = observed_maximum(source, process_ts_col)
    return materialize(source, "export-hour"), seen
