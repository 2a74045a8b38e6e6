"""The incremental identity load over several batches, against one full load in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from histkit.catalog import identity_queries as iq
from histkit.catalog.registry import ntz, query
from histkit.operators.components import shared_value_links
from histkit.plans import identity_delta as delta
from histkit.sources.files import scratch_dir

# Ends of the batches, at whole local hours.
CUTS = ("2024-01-11 05:00:00", "2024-01-21 05:00:00")
LOADED = ("2024-02-01", "2024-02-02", "2024-02-03")

_FLAGS = f"""
      {iq._flag("first_name", "best_first_name")} as is_best_first_name, {iq._flag("last_name", "best_last_name")} as is_best_last_name,
      {iq._flag("email_address", "best_email_address")} as is_best_email_address, {iq._flag("phone_number", "best_phone_number")} as is_best_phone_number,
      case when not addr and not best_addr then null when addr and best_addr and city = best_city and best_country is null then true else false end as is_best_address,
      case when id_source = 'legacy-account' then {iq._flag("legacy_account_id", "primary_legacy_account_id")}
           else {iq._flag("identity_id", "primary_identity_id")} end as is_primary"""


def full_load_sql(cond: str = "true") -> str:
    """Every row of a full load over the events of a condition, with flags and prior person."""
    return f"""
    with {iq.stages_sql(cond)}, {iq.LINE_SQL.format(spine=iq.spine_sql())}, {iq.LEGACY_SQL}, {iq.HISTORY_SQL}
    select identity_id, person_id, case id_source when 'billing' then hh_individual_id when 'legacy' then legacy_individual_id end as individual_id,
           id_source as individual_id_source, email_address, first_name, last_name, phone_number, city, create_est_timestamp as created_est_timestamp,
           valid_from_date_hour as valid_from_est_timestamp, valid_to_date_hour as valid_to_est_timestamp, is_current, is_identity_deleted as is_deleted,
           billing_profile_id, subscription_id, legacy_subscription_id, billing_valid_from as billing_profile_valid_from_est_timestamp,
           legacy_account_id as linked_legacy_account_id, case when prior is distinct from person_id then prior end as prior_person_id, {_FLAGS}
    from (select *, is_billing_deleted is not distinct from false as addr,
                 hit and (best_first_name is not null or best_last_name is not null or best_city is not null) as best_addr from hist2)"""


def _flat(history):
    return ntz(
        history.where("source = 'primary'").select(
            "identity_id",
            "person_id",
            "individual_id",
            "individual_id_source",
            "email_address",
            "first_name",
            "last_name",
            "phone_number",
            F.col("address_struct.city").alias("city"),
            "created_est_timestamp",
            "valid_from_est_timestamp",
            "valid_to_est_timestamp",
            "is_current",
            "is_deleted",
            *[
                f"additional_info_struct.{c}"
                for c in (
                    "billing_profile_id",
                    "subscription_id",
                    "legacy_subscription_id",
                    "billing_profile_valid_from_est_timestamp",
                    "linked_legacy_account_id",
                )
            ],
            "prior_person_struct.prior_person_id",
            *iq.FLAG_NAMES,
        )
    )


def loaded(spark, sf, conditions, buckets=4):
    """The tables after one load per condition on the events."""
    tables = delta.IdentityTables(scratch_dir(spark, "identity"), buckets)
    devices, individuals, known = iq._legacy_tables(spark, sf)
    for k, where in enumerate(conditions):
        batch = iq.stages(spark, sf, where, hourly=True)
        delta.load_identity_batch(spark, tables, batch, k + 1, devices, individuals, LOADED[k], known if k == 0 else None)
    return tables


def _by_time():
    a, b = (F.lit(c).cast("timestamp_ntz") for c in CUTS)
    return [F.col("ts") < a, (F.col("ts") >= a) & (F.col("ts") < b), F.col("ts") >= b]


@query("identity_load_delta", full_load_sql())
def identity_load_delta(spark, sf):
    """Three batches in order of time give the history of one full load."""
    return _flat(loaded(spark, sf, _by_time()).history.read(spark))


@query("identity_load_late", full_load_sql())
def identity_load_late(spark, sf):
    """So do batches whose hours are mixed: later ones are cut into the history of earlier ones."""
    turn = F.pmod(F.hour("ts") * 7 + F.dayofyear("ts"), F.lit(2))
    return _flat(loaded(spark, sf, [turn == k for k in (1, 0)]).history.read(spark))


def _before(k: int) -> str:
    return f"ts < timestamp '{CUTS[k]}'" if k < len(CUTS) else "true"


@query(
    "identity_load_reflagged",
    f"""with one as ({full_load_sql(_before(0))}), two as ({full_load_sql(_before(1))}),
    batch as (select distinct user_id from events where ts >= timestamp '{CUTS[0]}' and ts < timestamp '{CUTS[1]}'),
    flagged as (select two.*, (one.person_id, one.is_primary, one.is_best_first_name, one.is_best_last_name, one.is_best_email_address,
                               one.is_best_phone_number, one.is_best_address) is distinct from
                              (two.person_id, two.is_primary, two.is_best_first_name, two.is_best_last_name, two.is_best_email_address,
                               two.is_best_phone_number, two.is_best_address) as changed
                from two join one using (identity_id, valid_from_est_timestamp))
    select identity_id not in (select user_id from batch) as outside_batch, changed, count(*) as row_count, count(distinct identity_id) as identities,
           count(*) filter (is_primary) as primaries
    from flagged group by all""",
)
def identity_load_reflagged(spark, sf):
    """What the second batch changes in flags and persons, of its own identities and of others."""
    keys = ["identity_id", "valid_from_est_timestamp"]
    names = ["person_id", *iq.FLAG_NAMES]
    tables = delta.IdentityTables(scratch_dir(spark, "identity"), 4)
    devices, individuals, known = iq._legacy_tables(spark, sf)
    first, second = _by_time()[:2]
    delta.load_identity_batch(spark, tables, iq.stages(spark, sf, first, hourly=True), 1, devices, individuals, LOADED[0], known)
    before = iq.materialize(tables.history.read(spark).select(*keys, F.struct(*names).alias("was")), "before")
    batch = iq.stages(spark, sf, second, hourly=True)
    delta.load_identity_batch(spark, tables, batch, 2, devices, individuals, LOADED[1])
    inside = iq.table(spark, sf, "events").where(second).select(F.col("user_id").alias("identity_id")).distinct().withColumn("inside", F.lit(True))
    rows = tables.history.read(spark).join(before, keys).join(inside, "identity_id", "left")
    changed = ~F.struct(*names).eqNullSafe(F.col("was"))
    return rows.groupBy(F.col("inside").isNull().alias("outside_batch"), changed.alias("changed")).agg(
        F.count("*").alias("row_count"), F.countDistinct("identity_id").alias("identities"), F.count_if("is_primary").alias("primaries")
    )


def _person_sql(k: int) -> str:
    return f"(with {iq.stages_sql(_before(k))}, {iq.LINE_SQL.format(spine=iq.spine_sql())}, {iq.LEGACY_SQL} select {iq.PERSON_COLUMNS} from p4)"


@query(
    "person_history",
    f"""with loads as (
      select 0 as k, * from {_person_sql(0)} union all select 1, * from {_person_sql(1)} union all select 2, * from {_person_sql(2)}),
    states as (select *, hash({iq.PERSON_COLUMNS.replace("person_id, ", "", 1)}) as whole from loads),
    changes as (select *, lag(whole) over (partition by person_id order by k) as before from states
                qualify before is null or before <> whole),
    versions as (select *, lead(k) over (partition by person_id order by k) as next from changes)
    select {iq.PERSON_COLUMNS}, timestamp '2024-01-31 19:00:00' + k * interval 1 day as valid_from_est_timestamp,
           coalesce(timestamp '2024-01-31 19:00:00' + next * interval 1 day, {iq.HIGH}) as valid_to_est_timestamp, next is null as is_current
    from versions""",
)
def person_history(spark, sf):
    """Versions of persons over three loads, as replaying the loads gives them."""
    return ntz(iq._flat_person(loaded(spark, sf, _by_time()).person_history.read(spark)))


@query(
    "person_merge",
    f"""{iq.FULL_LINE}, {iq.LEGACY_SQL},
    edges as (
      select a.person_id as a, b.person_id as b from p4 a join (select best_email_address, min(person_id) as person_id from p4 group by 1) b
        using (best_email_address)
      union select a.person_id, b.person_id from p4 a join (select best_phone_number, min(person_id) as person_id from p4 group by 1) b
        using (best_phone_number)),
    both_ways as (select a, b from edges union select b, a from edges),
    reach as (
      with recursive r as (select a as node, a as other from both_ways union select r.node, e.b from r join both_ways e on e.a = r.other)
      select node, min(other) as root from r group by node),
    named as (
      select p4.*, coalesce(root, person_id) as root,
        row_number() over (partition by coalesce(root, person_id) order by
          case source when 'primary' then 1 when 'legacy' then 2 when 'legacy-account' then 3 when 'identity' then 4 else 5 end,
          individual_id is null, person_id) as place
      from p4 left join reach on node = person_id),
    led as (
      select *, first_value(person_id) over w as survivor, first_value(primary_identity_id ignore nulls) over w as first_identity,
        first_value(primary_legacy_account_id ignore nulls) over w as first_account
      from named window w as (partition by root order by place rows between unbounded preceding and unbounded following))
    select person_id, source, individual_id, best_email_address, best_phone_number,
      case when place = 1 then coalesce(primary_identity_id, first_identity) end as primary_identity_id,
      case when place = 1 then coalesce(primary_legacy_account_id, first_account) end as primary_legacy_account_id,
      case when place > 1 then primary_identity_id end as prior_primary_identity_id,
      case when place > 1 then primary_legacy_account_id end as prior_primary_legacy_account_id,
      case when place > 1 then survivor end as merged_person_id, case when place > 1 then 'merged' else state end as state
    from led""",
)
def person_merge(spark, sf):
    """Persons that share a best email address or phone number, over any number of steps, are one."""
    devices, individuals, known = iq._legacy_tables(spark, sf)
    line = iq.stored_timeline(spark, sf)
    person = iq.materialize(iq.rs.resolve_persons(known, line, devices, individuals), "person")
    links = shared_value_links(person, "person_id", ["best_email_address", "best_phone_number"])
    merged = iq.rs.merge_persons(person, links, iq.materialize)
    return merged.select(
        "person_id",
        "source",
        "individual_id",
        "best_email_address",
        "best_phone_number",
        "primary_identity_id",
        "primary_legacy_account_id",
        "prior_primary_identity_id",
        "prior_primary_legacy_account_id",
        "merged_person_id",
        "state",
    )
