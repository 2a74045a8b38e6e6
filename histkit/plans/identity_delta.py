"""Incremental identity load: batches of hourly source rows merged into stored tables.

What is stored under one folder, each table by hash buckets of its key:

* ``hours_<source>``: the hourly rows of each source, appended per load;
* ``line``: the unified timeline;
* ``links``: which identities a person can be found for, by kind and natural key;
* ``person`` and ``person_history``: the persons now, and their versions;
* ``history``: the identity history; ``accounts``: the rows of legacy accounts.

A batch changes the timeline of its own identities from their first new hour on. The state
before that hour is one border row per source, the last change of its staging history. Persons
change where those rows met them, before or after; an identity outside the batch is rewritten
when one of its rows belongs to such a person, as its flags compare with the person's best values.

Tables are written so that a load that broke off can be repeated: persons and timeline, with
which the batch is compared, come last.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime


from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histkit.functions.times import DEFAULT_ZONE, local_time, open_end, timestamp_literal
from histkit.operators import resolve as rs
from histkit.operators.events import union_all
from histkit.operators.merge import ACTION
from histkit.operators.scd2 import stage_of_hours
from histkit.operators.timeline import DEFAULT_LABELS, HOUR, Labels, splice, unified_timeline
from histkit.sources.buckets import BucketTable, newest_load
from histkit.sources.files import materialize

KEY = "identity_id"
#: The columns of each source whose change makes a new staging row.
TRACKED = {
    "idt": ("email_address", "phone_number"),
    "bp": ("first_name", "last_name", "address_struct"),
    "hh": ("individual_id", "household_id"),
    "event_sub": ("individual_id", "account_id"),
    "legacy_sub": ("individual_id", "account_id"),
}


@dataclass(frozen=True)
class IdentityTables:
    base: str
    buckets: int = 64
    labels: Labels = DEFAULT_LABELS
    tracked: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(TRACKED))

    def _table(self, name: str, *keys: str) -> BucketTable:
        return BucketTable(f"{self.base.rstrip('/')}/{name}", keys, self.buckets)

    def hours(self, source: str) -> BucketTable:
        return self._table(f"hours_{source}", KEY)

    @property
    def line(self) -> BucketTable:
        return self._table("line", KEY)

    @property
    def links(self) -> BucketTable:
        return self._table("links", "_kind", "_natural")

    @property
    def person(self) -> BucketTable:
        return self._table("person", "person_id")

    @property
    def person_history(self) -> BucketTable:
        return self._table("person_history", "person_id")

    @property
    def history(self) -> BucketTable:
        return self._table("history", KEY)

    @property
    def accounts(self) -> BucketTable:
        return self._table("accounts", "legacy_account_id")


def since_border(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Staging rows of the cut keys from their cut on, and the last one before it."""
    rows = rows.join(cuts, KEY)
    early = F.col(HOUR) < F.col("_cut")
    last = F.max(F.when(early, F.col(HOUR))).over(Window.partitionBy(KEY))
    return rows.withColumn("_last", last).where(~early | (F.col(HOUR) == F.col("_last"))).drop("_cut", "_last")


def delta_stages(tables: IdentityTables, batch: Mapping[str, DataFrame], cuts: DataFrame, load: int) -> dict[str, DataFrame]:
    """Staging histories of the batch's identities from their border rows on."""
    spark, out = cuts.sparkSession, {}
    for name, new in batch.items():
        rows = new.withColumn("_load", F.lit(int(load)))
        table = tables.hours(name)
        if table.exists(spark):
            rows = table.of_keys(cuts, before=load).select(*rows.columns).unionByName(rows)
        rows = newest_load(rows, [KEY, HOUR])  # an hour that comes again replaces the stored one
        # The border is the last change, not the last hour: columns that are kept but not tracked come from it.
        out[name] = since_border(stage_of_hours(rows, KEY, list(tables.tracked[name])), cuts)
    return out


def spliced_timeline(old: DataFrame | None, stages: Mapping[str, DataFrame], cuts: DataFrame, labels: Labels) -> tuple[DataFrame, DataFrame]:
    """(timeline of the cut keys, rows of it that are new or were replaced)."""
    to = "valid_to_date_hour"
    fresh = unified_timeline(stages, labels=labels)
    fresh = fresh.join(cuts, KEY).where(F.col(HOUR) >= F.col("_cut")).select(*fresh.columns)
    if old is None:
        return fresh, fresh
    fresh = materialize(fresh, "fresh-line")
    known = old.join(cuts, KEY)
    early = F.col(HOUR) < F.col("_cut")
    end = open_end(old.schema[HOUR].dataType)
    # The delta knows everything from the cut on: older rows that reach it are open there, later ones are void.
    kept = known.where(early).withColumn(to, F.when(F.col(to) > F.col("_cut"), end).otherwise(F.col(to)))
    rows = splice(kept.select(*old.columns), fresh.select(*old.columns), [KEY], HOUR, to)
    alive = F.coalesce(F.col("is_identity_deleted") == F.lit(False), F.lit(False))
    rows = rows.withColumn("is_current", alive & (F.col(to) == end))
    return rows, fresh.unionByName(known.where(~early).select(*old.columns))


def _naturals(line: DataFrame, labels: Labels) -> DataFrame:
    kind, natural = rs.natural_key(labels)
    return line.select(kind.alias("_kind"), natural.alias("_natural"), KEY).where(F.col("_natural").isNotNull()).distinct()


def _of_line(tables: IdentityTables, stored: DataFrame | None, changed: DataFrame) -> DataFrame:
    """Timeline rows as they will be: the changed identities' new rows instead of the stored ones."""
    if stored is None:
        return changed
    return stored.join(changed.select(KEY).distinct(), KEY, "left_anti").select(*changed.columns).unionByName(changed)


def _billed(line: DataFrame, individuals: DataFrame, labels: Labels) -> DataFrame:
    rows = line.where((F.col("id_source") == labels.billing) & F.col("hh_individual_id").isNotNull())
    return rows.join(individuals, "hh_individual_id", "left_semi").select(*line.columns)


def changed_persons(person: DataFrame, touched: DataFrame, candidates: DataFrame, own_line: DataFrame, labels: Labels) -> DataFrame:
    """Persons that the touched keys make or change, as they will be."""
    ways = rs.ways_to_persons(person, labels).join(touched, ["_kind", "_natural"], "left_semi")
    ids = ways.select(F.col("p_person_id").alias("person_id")).distinct()
    known = materialize(person.join(ids, "person_id", "left_semi").select(*person.columns), "met-persons")
    billed = rs.upsert_primary_persons(known, candidates, labels).where(F.col(ACTION).isin("update", "insert"))
    alone = touched.where("_kind = 'identity'").select("_natural")
    own_line = own_line.join(alone, F.col(KEY).cast("string") == F.col("_natural"), "left_semi")
    single = rs.refresh_identity_persons(known, own_line, labels).where(F.col(ACTION).isin("update", "insert"))
    return billed.drop(ACTION).unionByName(single.drop(ACTION))


def person_versions(open_rows: DataFrame | None, changed: DataFrame, as_of: str | datetime, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Change capture of the person table: the changed persons' versions, with what was open closed at ``as_of``.

    ``open_rows``: all stored versions of these persons. A version that began at ``as_of`` itself (a
    repeated load) is replaced.
    """
    now = local_time(timestamp_literal(as_of), zone)
    new = changed.withColumns({"valid_from_est_timestamp": now, "valid_to_est_timestamp": open_end(), "is_current": F.lit(True)})
    if open_rows is None:
        return new
    before = open_rows.where(F.col("valid_from_est_timestamp") < now)
    closed = F.col("valid_to_est_timestamp") >= now
    before = before.withColumns(
        {"valid_to_est_timestamp": F.when(closed, now).otherwise(F.col("valid_to_est_timestamp")), "is_current": F.lit(False)}
    )
    return before.select(*new.columns).unionByName(new)


def load_identity_batch(
    spark: SparkSession,
    tables: IdentityTables,
    batch: Mapping[str, DataFrame],
    load: int,
    devices: DataFrame,
    individuals: DataFrame,
    as_of: str | datetime,
    first_persons: DataFrame | None = None,
) -> None:
    """Merge a numbered batch of hourly rows (:func:`histkit.operators.scd2.hourly_rows`) per source.

    The first load also makes the persons of the legacy tables, beginning with ``first_persons``;
    later loads take those tables as they were. Loading all batches, in any order of their hours, gives the timeline
    and history of one full load over all rows, provided that no hour of a source and identity is in two of them.
    A person that only rows since replaced stood for stays in the person table.
    """
    labels, first = tables.labels, first_persons is not None
    batch = {n: materialize(df.where(F.col(KEY).isNotNull()), f"batch-{n}") for n, df in batch.items()}
    cuts = union_all([df.select(KEY, HOUR) for df in batch.values()]).groupBy(KEY).agg(F.min(HOUR).alias("_cut"))
    cuts = materialize(cuts, "cuts")

    stages = delta_stages(tables, batch, cuts, load)
    old = None if first else tables.line.of_keys(cuts)
    line, moved = spliced_timeline(old, stages, cuts, labels)
    line = materialize(line, "line")
    new_links = _naturals(line, labels)

    if first:
        persons = materialize(rs.resolve_persons(first_persons, line, devices, individuals, labels), "persons")
        changed, affected = persons, line
    else:
        touched = materialize(_naturals(moved, labels).select("_kind", "_natural").distinct(), "touched")
        kin = tables.links.of_keys(touched).select(KEY).unionByName(line.select(KEY)).distinct()
        near = _of_line(tables, tables.line.of_keys(kin), line)
        billed = touched.where("_kind = 'individual'").select(F.col("_natural").alias("hh_individual_id"))
        person = tables.person.read(spark)
        changed = materialize(changed_persons(person, touched, _billed(near, billed, labels), line, labels), "changed-persons")
        persons = person.join(changed.select("person_id"), "person_id", "left_anti").select(*changed.columns).unionByName(changed)
        # Identities that any row leads to a changed person, whether the batch has them or not.
        met = rs.ways_to_persons(changed, labels).select("_kind", "_natural").distinct()
        kin = tables.links.of_keys(met).select(KEY).unionByName(line.select(KEY)).distinct()
        affected = _of_line(tables, tables.line.of_keys(kin), line)

    history = materialize(rs.identity_history(affected, persons, labels, as_of), "history")
    of_changed = changed.select("individual_id", F.when(F.col("source") == labels.account, F.col("primary_legacy_account_id")).alias("account_id"))
    met = devices.join(of_changed.where("individual_id is not null").select("individual_id").distinct(), "individual_id", "left_semi").select("account_id")
    met = met.unionByName(of_changed.select("account_id")).where("account_id is not null").distinct()
    if first:
        met = devices.where("account_id is not null").select("account_id").distinct()
    met = materialize(met, "accounts")
    accounts = rs.legacy_account_history(devices.join(met, "account_id", "left_semi").select(*devices.columns), individuals, persons, labels, as_of=as_of)

    for name, rows in batch.items():
        tables.hours(name).append(rows, load)
    by_account = met.withColumnRenamed("account_id", "legacy_account_id")
    if first:
        tables.history.write(history)
        tables.accounts.write(accounts)
        tables.links.write(new_links)
        tables.person_history.write(person_versions(None, changed, as_of))
        tables.person.write(persons)
        tables.line.write(line)
        return
    tables.history.replace(history.select(KEY), history)
    tables.accounts.replace(by_account, accounts)
    linked = tables.links.of_keys(new_links).unionByName(new_links).distinct()
    tables.links.replace(new_links, linked)
    tables.person_history.replace(changed, person_versions(tables.person_history.of_keys(changed), changed, as_of))
    tables.person.replace(changed, changed)
    tables.line.replace(cuts, line)


def stored_history(spark: SparkSession, tables: IdentityTables) -> DataFrame:
    """The whole identity history, legacy accounts included."""
    return union_all([tables.history.read(spark), tables.accounts.read(spark)])
