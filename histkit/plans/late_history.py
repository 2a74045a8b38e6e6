"""A type-2 history that takes events in any order: late ones are cut into closed history.

Stored are the batches' reduced events (one per key and interval, changed or not) and the
history, both in hash buckets of the key. A batch reads the buckets of its keys, builds their
history anew from the event before its first one on, puts it in the place of the stored
rows, and rewrites these buckets. Events that changed nothing are kept too, as a late event before them
can make them a change.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histkit.functions.times import open_end
from histkit.operators.scd2 import DEFAULT_COLUMNS, HASH_EXCLUDE, Scd2Columns, scd2_changes
from histkit.sources.buckets import BucketTable, newest_load
from histkit.sources.files import materialize


@dataclass(frozen=True)
class LateHistory:
    base: str
    keys: tuple[str, ...]
    buckets: int = 64
    deleted: str | None = None
    exclude: tuple[str, ...] = HASH_EXCLUDE
    cols: Scd2Columns = DEFAULT_COLUMNS

    @property
    def events(self) -> BucketTable:
        return BucketTable(f"{self.base.rstrip('/')}/events", self.keys, self.buckets)

    @property
    def history(self) -> BucketTable:
        return BucketTable(f"{self.base.rstrip('/')}/history", self.keys, self.buckets)


def _from_border(rows: DataFrame, cuts: DataFrame, keys: Sequence[str], start: str) -> DataFrame:
    """Events of the cut keys from the cut on, and the last one before it."""
    rows = rows.join(cuts, list(keys))
    early = F.col(start) < F.col("_cut")
    last = F.max(F.when(early, F.col(start))).over(Window.partitionBy(*keys))
    return rows.withColumn("_last", last).where(~early | (F.col(start) == F.col("_last"))).drop("_last")


def load_in_any_order(spark: SparkSession, tables: LateHistory, batch: DataFrame, load: int) -> None:
    """Merge a numbered batch: seeded events (:func:`histkit.operators.scd2.projected_events`) with at most one row per key
    and start.

    The history afterwards is the one of all events so far, whatever the order of the batches;
    a start that comes again replaces the stored event, and a load that is repeated changes
    nothing. Events with a null key or start are left out. What a key holds from the border on meets in one task, as in any
    window over it, so reduce events to hours or days first.
    """
    cols, keys = tables.cols, list(tables.keys)
    usable = F.col(cols.valid_from).isNotNull()
    for k in keys:
        usable &= F.col(k).isNotNull()
    batch = materialize(batch.where(usable), "batch")
    cuts = materialize(batch.groupBy(*keys).agg(F.min(cols.valid_from).alias("_cut")), "cuts")
    rows = batch.withColumn("_load", F.lit(int(load)))
    if tables.events.exists(spark):
        rows = tables.events.of_keys(cuts, before=load).select(*rows.columns).unionByName(rows)
    rows = _from_border(newest_load(rows, [*keys, cols.valid_from]), cuts, keys, cols.valid_from)
    fresh = scd2_changes(rows.drop("_cut"), None, keys, [cols.valid_from], tables.exclude, deleted=tables.deleted, cols=cols)
    fresh = fresh.join(cuts, keys).where(F.col(cols.valid_from) >= F.col("_cut")).drop("_cut")
    first = not tables.history.exists(spark)
    if first:
        tables.events.append(batch, load)
        tables.history.write(fresh)
        return
    fresh = materialize(fresh, "fresh")
    old = tables.history.of_keys(cuts)
    known = old.join(cuts, keys)
    early = F.col(cols.valid_from) < F.col("_cut")
    end = open_end(old.schema[cols.valid_from].dataType, cols.high)
    # Older rows that reach the cut end at the first new row, or stay open; all later rows are void.
    kept = known.where(early).withColumn(cols.valid_to, F.when(F.col(cols.valid_to) > F.col("_cut"), end).otherwise(F.col(cols.valid_to)))
    rows = kept.select(*old.columns).unionByName(fresh.select(*old.columns))
    following = F.lead(cols.valid_from).over(Window.partitionBy(*keys).orderBy(cols.valid_from))
    lasts = F.col(cols.valid_from) < F.col(cols.valid_to)  # no tombstone
    until = F.when(lasts, F.least(F.col(cols.valid_to), F.coalesce(following, end))).otherwise(F.col(cols.valid_to))
    rows = rows.withColumn(cols.valid_to, until)
    rows = materialize(rows.withColumn(cols.is_current, lasts & (F.col(cols.valid_to) == end)), "rebuilt")
    tables.events.append(batch, load)
    tables.history.replace(cuts, rows)
