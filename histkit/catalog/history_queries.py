"""Change detection, hashing, validity and whole type-2 pipelines."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from histkit.catalog.event_queries import ENVELOPE_SQL, envelope_type
from histkit.catalog.registry import ntz, prop, query, table
from histkit.config import Interval, JobSpec, ReadSpec, WriteSpec
from histkit.functions.hashing import row_hash
from histkit.functions.times import local_time
from histkit.operators import events as ev
from histkit.operators import merge as mg
from histkit.operators import scd2, segments
from histkit.plans import late_history
from histkit.plans.history_job import run_history_job
from histkit.sources import files
from histkit.sources.files import materialize

AS_OF = "2024-02-01 00:00:00"
HIGH_SQL = "timestamp '9999-12-31 00:00:00'"


# Cut keys from this many rows on, so that the small test tables use the cut windows too.
# On big tables the share of a key decides.
SMALL = 8


def order_slices(ts: str):
    """Day, then blocks of order keys: at most a million rows of a customer per slice."""
    return F.struct(F.col(ts), F.floor(F.col("o_orderkey") / 1_000_000))


def orders_log(spark, sf):
    return table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )


@query(
    "change_lag_hash",
    """
    select o_custkey, o_orderkey, o_orderdate, o_orderstatus from (
      select *, lag(o_orderstatus) over (partition by o_custkey order by o_orderdate, o_orderkey) as before
      from orders)
    where before is null or before <> o_orderstatus
    """,
)
def change_lag_hash(spark, sf):
    df = orders_log(spark, sf).drop("o_orderpriority")
    return scd2.drop_sequential_unchanged(
        df,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        exclude=["o_custkey", "o_orderkey", "o_orderdate"],
        slice_by=order_slices("o_orderdate"),
        hot_rows=SMALL,
    )


CHANGE_SQL = """
    select event_id, user_id, ts, event_type, is_deleted from (
      select *, lag(event_type) over w as before, lag(is_deleted) over w as before_deleted
      from (select *, event_type = 'error' as is_deleted from events)
      window w as (partition by user_id order by ts, event_id))
    where before is null or before <> event_type or before_deleted <> is_deleted or is_deleted
    """


@query("change_lag_struct", CHANGE_SQL)
def change_lag_struct(spark, sf):
    return _changes(spark, sf, hot_rows=SMALL)


@query("change_lag_struct_default", CHANGE_SQL)
def change_lag_struct_default(spark, sf):
    return _changes(spark, sf)


def _changes(spark, sf, **hot):
    df = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", "event_type", (F.col("event_type") == "error").alias("is_deleted")
    )
    return scd2.drop_sequential_unchanged(
        df, ["user_id"], ["ts", "event_id"], tracked=["event_type"], deleted="is_deleted", slice_by=F.date_trunc("MINUTE", "ts"), **hot
    )


@query("change_scan_segments", CHANGE_SQL)
def change_scan_segments(spark, sf):
    """The same changes by a segmented scan: ranges of key and time, whatever a key holds."""
    df = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", "event_type", (F.col("event_type") == "error").alias("is_deleted")
    )
    return segments.changed_rows(df, ["user_id"], ["ts", "event_id"], ["event_type"], materialize, "is_deleted")


VALIDITY_SQL = f"""
    select *, valid_to_est_timestamp = {HIGH_SQL} as is_current from (
      select o_custkey, o_orderkey, o_orderdate as valid_from_est_timestamp,
             coalesce(lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey),
                      {HIGH_SQL}) as valid_to_est_timestamp
      from orders)
    """


@query("validity_lead", VALIDITY_SQL)
def validity_lead(spark, sf):
    return _validity(spark, sf, hot_rows=SMALL)


@query("validity_lead_default", VALIDITY_SQL)
def validity_lead_default(spark, sf):
    return _validity(spark, sf)


def _validity(spark, sf, **hot):
    df = orders_log(spark, sf).select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").alias("valid_from_est_timestamp")
    )
    return scd2.build_validity(
        df,
        ["o_custkey"],
        ["valid_from_est_timestamp", "o_orderkey"],
        slice_by=order_slices("valid_from_est_timestamp"),
        **hot,
    )


@query(
    "row_hash",
    """select c_custkey, md5(concat_ws('', c_custkey::varchar, c_mktsegment, c_name, c_nationkey::varchar)) as hash_md5
       from customer""",
)
def hash_compat(spark, sf):
    df = table(spark, sf, "customer").drop("c_acctbal")
    return row_hash(df, compat=True).select("c_custkey", "hash_md5")


@query(
    "row_hash_null_safe",
    """select c_custkey, md5('{"c_custkey":' || c_custkey || ',"c_mktsegment":' ||
         coalesce('"' || nullif(c_mktsegment, 'BUILDING') || '"', 'null') || ',"c_name":"' || c_name ||
         '","c_nationkey":' || c_nationkey || '}') as hash_md5
       from customer""",
)
def hash_default(spark, sf):
    df = table(spark, sf, "customer").drop("c_acctbal")
    df = df.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return row_hash(df).select("c_custkey", "hash_md5")


@query(
    "row_hash_map_order",
    """select event_id, true as same_hash,
         md5('{"event_id":' || event_id || ',"m":[{"key":"k","value":"' || (props->>'k') ||
             '"},{"key":"type","value":"' || event_type || '"}]}') as hash_md5
       from events""",
)
def hash_map_order(spark, sf):
    k, kind = prop(), F.col("event_type")
    df = table(spark, sf, "events").select(
        "event_id",
        F.create_map(F.lit("type"), kind, F.lit("k"), k).alias("m"),
        F.create_map(F.lit("k"), k, F.lit("type"), kind).alias("other"),
    )
    one = row_hash(df, exclude=["other"])
    both = row_hash(one.withColumnsRenamed({"m": "first", "other": "m"}), ["first", "hash_md5"], "hash_other")
    return both.select("event_id", (F.col("hash_md5") == F.col("hash_other")).alias("same_hash"), "hash_md5")


ORDER_CUT = "1999-01-01 00:00:00"
LATEST_ORDER = """select o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority from orders
                  where {cond} qualify row_number() over (
                    partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""


@query(
    "unchanged_vs_target",
    f"""
    with t as ({LATEST_ORDER.format(cond=f"o_orderdate < timestamp '{ORDER_CUT}'")}),
         s as ({LATEST_ORDER.format(cond=f"o_orderdate >= timestamp '{ORDER_CUT}'")})
    select s.o_custkey, s.o_orderkey, s.o_orderstatus, s.o_orderpriority
    from s left join t using (o_custkey)
    where t.o_custkey is null or t.o_orderstatus = 'F'
       or t.o_orderstatus <> s.o_orderstatus or t.o_orderpriority <> s.o_orderpriority
    """,
)
def unchanged_vs_target(spark, sf):
    log, order = orders_log(spark, sf), ["o_orderdate", "o_orderkey"]
    before = F.col("o_orderdate") < F.lit(ORDER_CUT).cast("timestamp_ntz")
    # Finished orders stand for closed target rows.
    target = ev.top_rank(log.where(before), ["o_custkey"], order).withColumn(
        "is_current", F.col("o_orderstatus") != "F"
    )
    src = ev.top_rank(log.where(~before), ["o_custkey"], order)
    rows = scd2.ignore_unchanged_vs_target(src, target, ["o_custkey"], ["o_orderkey", "o_orderdate", "is_current"])
    return rows.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")


def daily_orders(spark, sf):
    log = ev.top_rank(orders_log(spark, sf), ["o_custkey", "o_orderdate"], ["o_orderkey"])
    return log.withColumnRenamed("o_orderdate", "valid_from_est_timestamp")


DAILY_SQL = """select o_custkey, o_orderkey, o_orderstatus, o_orderdate as vf from orders
               qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1"""


CONSOLIDATE_SQL = f"""
    with d as ({DAILY_SQL}),
         t as (select *, lead(vf) over (partition by o_custkey order by vf) is null as cur
               from d where vf < timestamp '{ORDER_CUT}'),
         m as (select o_custkey, max(vf) as newest from t group by 1)
    select d.o_custkey, d.o_orderkey, d.o_orderstatus, d.vf as valid_from_est_timestamp, false as is_current
    from d left join m using (o_custkey)
    where d.vf >= timestamp '1998-01-01' and (m.newest is null or d.vf > m.newest)
    union all
    select o_custkey, o_orderkey, o_orderstatus, vf, true from t where cur"""
BATCH_KEYS = "select o_custkey from d where vf >= timestamp '1998-01-01'"


@query("consolidate_target", f"{CONSOLIDATE_SQL} and o_custkey in ({BATCH_KEYS})")
def consolidate_target(spark, sf):
    batch, target = _batch_and_target(spark, sf)
    rows = scd2.consolidate(batch, target, ["o_custkey"])
    return rows.select("o_custkey", "o_orderkey", "o_orderstatus", "valid_from_est_timestamp", "is_current")


@query("consolidate_all_current", CONSOLIDATE_SQL)
def consolidate_all_current(spark, sf):
    batch, target = _batch_and_target(spark, sf)
    rows = scd2.consolidate(batch, target, ["o_custkey"], all_current=True)
    return rows.select("o_custkey", "o_orderkey", "o_orderstatus", "valid_from_est_timestamp", "is_current")


@query(
    "late_events",
    f"""
    with d as ({DAILY_SQL}),
         t as (select *, lead(vf) over (partition by o_custkey order by vf) is null as cur
               from d where vf < timestamp '{ORDER_CUT}'),
         m as (select o_custkey, max(vf) as newest from t group by 1)
    select d.o_custkey, d.o_orderkey, d.vf as valid_from_est_timestamp from d join m using (o_custkey)
    where d.vf >= timestamp '1998-01-01' and d.vf <= m.newest
    """,
)
def late_events(spark, sf):
    """What the batch brings too late, for a reject table."""
    batch, target = _batch_and_target(spark, sf)
    return scd2.late_events(batch, target, ["o_custkey"]).select("o_custkey", "o_orderkey", "valid_from_est_timestamp")


def _batch_and_target(spark, sf):
    log = daily_orders(spark, sf).drop("o_orderpriority")
    at = F.col("valid_from_est_timestamp")
    target = scd2.build_validity(log.where(at < F.lit(ORDER_CUT).cast("timestamp_ntz")), ["o_custkey"])
    # The batch overlaps the target by a year; what is not newer is dropped.
    batch = log.where(at >= F.lit("1998-01-01").cast("timestamp_ntz")).withColumns(
        {"valid_to_est_timestamp": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(False)}
    )
    return batch, target


HOURLY_SQL = """select event_id, user_id, event_type, value, ts - interval 5 hour as vf, event_type = 'error' as is_deleted
                from events qualify row_number() over (
                  partition by user_id, date_trunc('hour', ts - interval 5 hour) order by ts desc, event_id desc) = 1"""


@query(
    "scd2_hourly",
    f"""
    with h as ({HOURLY_SQL}),
         c as (select *, lag(event_type) over (partition by user_id order by vf) as before from h),
         v as (select event_id, user_id, event_type, vf as valid_from_est_timestamp,
                      coalesce(lead(vf) over (partition by user_id order by vf), {HIGH_SQL}) as valid_to_est_timestamp
               from c where before is null or before <> event_type)
    select *, valid_to_est_timestamp = {HIGH_SQL} as is_current from v
    """,
)
def scd2_hourly(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    df = ev.latest_per_interval(df, "ts", ["user_id"], ["ts", "event_id"], Interval.HOUR)
    df = df.withColumn("valid_from_est_timestamp", local_time("ts")).drop("ts")
    by = ["valid_from_est_timestamp"]
    df = scd2.drop_sequential_unchanged(df, ["user_id"], by, tracked=["event_type"])
    return ntz(scd2.build_validity(df, ["user_id"]))


def job(interval: Interval = Interval.HOUR) -> JobSpec:
    return JobSpec(
        ReadSpec(
            from_tables=("events",),
            source_keys=("user_id",),
            order_by=(("ts", "desc"), ("etl_metadata_struct.is_deleted", "desc"), ("event_id", "desc")),
            event_type_col="envelope_type",
            event_ts_col="ts",
            interval=interval,
        ),
        WriteSpec(
            to_table="user_history",
            target_keys=("user_id",),
            target_order_by=("valid_from_est_timestamp",),
            hash_exclude=(
                "valid_from_est_timestamp",
                "valid_to_est_timestamp",
                "is_current",
                "etl_metadata_struct",
                "event_id",
                "value",
            ),
        ),
    )


def crud_events(spark, sf):
    return table(spark, sf, "events").withColumn("envelope_type", envelope_type())


def project_user(df):
    return df.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "valid_from_est_timestamp",
        "valid_to_est_timestamp",
        "is_current",
        "etl_metadata_struct",
    )


def flat_history(df):
    return ntz(
        df.select(
            "event_id",
            "user_id",
            "event_type",
            "valid_from_est_timestamp",
            "valid_to_est_timestamp",
            "is_current",
            F.col("etl_metadata_struct.is_deleted").alias("is_deleted"),
        )
    )


def full_sql(source: str, key: str = "user_id") -> str:
    """History of deduplicated events with deletes: the SQL of the whole pipeline."""
    return f"""
    with h as ({source}),
         c as (select *, lag(event_type) over w as b1, lag(is_deleted) over w as b2
               from h window w as (partition by {key} order by vf)),
         v as (select *, coalesce(lead(vf) over (partition by {key} order by vf), {HIGH_SQL}) as vt
               from c where b1 is null or b1 <> event_type or b2 <> is_deleted or is_deleted)
    select event_id, user_id, event_type, vf as valid_from_est_timestamp,
           case when is_deleted then vf else vt end as valid_to_est_timestamp,
           case when is_deleted then false else vt = {HIGH_SQL} end as is_current, is_deleted
    from v"""


EVENT_SQL = "select event_id, user_id, event_type, ts - interval 5 hour as vf, event_type = 'error' as is_deleted from events"


@query("scd2_full", full_sql(HOURLY_SQL))
def scd2_full(spark, sf):
    return flat_history(scd2.scd2_pipeline(crud_events(spark, sf), None, job(), AS_OF, project_user))


@query("scd2_every_event", full_sql(EVENT_SQL))
def scd2_every_event(spark, sf):
    """No reduction to hours: a key may be of any size, so the windows are cut by hour."""
    spec = job(Interval.EVENT)
    rows = scd2.scd2_pipeline(crud_events(spark, sf), None, spec, AS_OF, project_user, store=materialize, hot_rows=SMALL)
    return flat_history(rows)


def two_loads(spark, sf):
    """A first load up to a local hour, then a delta of everything after it."""
    log = crud_events(spark, sf)
    cut = F.lit("2024-01-16 05:00:00").cast("timestamp_ntz")
    first = scd2.scd2_pipeline(log.where(F.col("ts") < cut), None, job(), AS_OF, project_user)
    first = materialize(first, "target")
    delta = scd2.scd2_pipeline(log.where(F.col("ts") >= cut), first, job(), AS_OF, project_user)
    return first, materialize(delta, "delta")


@query("scd2_incremental", full_sql(HOURLY_SQL))
def scd2_incremental(spark, sf):
    """First load plus delta merge must equal one full rebuild."""
    first, delta = two_loads(spark, sf)
    return flat_history(mg.merged_rows(mg.merge_scd2_current(first, delta, ["user_id"])))


@query("history_job_delta", full_sql(HOURLY_SQL))
def history_job_delta(spark, sf):
    """The whole job: a first load and two deltas into a versioned target equal one rebuild."""
    base = files.scratch_dir(spark, "user-history")
    spec = replace(job(), write=replace(job().write, to_table=base))
    log = crud_events(spark, sf)
    cuts = [None, "2024-01-12 05:00:00", "2024-01-21 05:00:00", None]
    for n, (start, end) in enumerate(zip(cuts, cuts[1:])):
        batch = log
        if start is not None:
            batch = batch.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
        if end is not None:
            batch = batch.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        run_history_job(spark, spec, batch, n + 1, AS_OF, project_user, first_load=n == 0)
    return flat_history(files.read_snapshot(spark, base))


@query("scd2_late_rebuild", full_sql(HOURLY_SQL))
def scd2_late_rebuild(spark, sf):
    """Batches whose hours are mixed: late events are cut into closed history, and the end equals one rebuild."""
    spec, log = job(), crud_events(spark, sf)
    tables = late_history.LateHistory(
        files.scratch_dir(spark, "late-history"), spec.write.target_keys, 8, scd2.DEFAULT_COLUMNS.deleted, spec.write.hash_exclude
    )
    turn = F.pmod(F.hour("ts") * 5 + F.dayofyear("ts"), F.lit(3))
    for load, k in enumerate((1, 2, 0)):
        batch = scd2.projected_events(log.where(turn == k), spec, AS_OF, project_user)
        late_history.load_in_any_order(spark, tables, batch, load)
    return flat_history(tables.history.read(spark))


@query(
    "scd2_deletes",
    f"""
    with h as ({HOURLY_SQL}),
         v as (select *, coalesce(lead(vf) over (partition by user_id order by vf), {HIGH_SQL}) as vt from h)
    select event_id, user_id, vf as valid_from_est_timestamp,
           case when is_deleted then vf else vt end as valid_to_est_timestamp,
           not is_deleted and vt = {HIGH_SQL} as is_current
    from v
    """,
)
def scd2_deletes(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    df = ev.latest_per_interval(df, "ts", ["user_id"], ["ts", "event_id"], Interval.HOUR)
    df = df.select(
        "event_id",
        "user_id",
        local_time("ts").alias("valid_from_est_timestamp"),
        F.struct((F.col("event_type") == "error").alias("is_deleted")).alias("etl_metadata_struct"),
    )
    rows = scd2.apply_deletes(scd2.build_validity(df, ["user_id"]))
    return ntz(rows.drop("etl_metadata_struct"))


STAGE_SQL = f"""
    with h as (select user_id, event_type, props->>'k' as k, event_type = 'error' as is_deleted,
                      date_trunc('hour', ts - interval 5 hour) as vh
               from events where ts >= timestamp '2024-01-01' and ts < timestamp '2024-01-29'
               qualify row_number() over (partition by user_id, date_trunc('hour', ts - interval 5 hour)
                 order by ts desc, event_type = 'error' desc, event_id desc) = 1),
         c as (select *, lag(event_type) over w as b1, lag(is_deleted) over w as b2 from h
               window w as (partition by user_id order by vh)),
         v as (select *, coalesce(lead(vh) over (partition by user_id order by vh), {HIGH_SQL}) as vt
               from c where b1 is null or b1 <> event_type or b2 <> is_deleted or is_deleted)
    select user_id, event_type, k, vh as valid_from_date_hour, vt as valid_to_date_hour,
           not is_deleted and vt = {HIGH_SQL} as is_current, is_deleted from v"""


@query("scd_stage_hourly", STAGE_SQL)
def scd_stage_hourly(spark, sf):
    df = ev.events_in_window(table(spark, sf, "events"), "2024-01-01", "2024-01-29", "ts")
    df = df.withColumns({"is_deleted": F.col("event_type") == "error", "k": prop()})
    order = ["ts", "is_deleted", "event_id"]
    return ntz(scd2.scd_stage(df, "user_id", ["event_type"], order, "ts", keep=["k"]))


@query(
    "audit_struct",
    f"""select event_id, timestamp '2024-01-31 19:00:00' as etl_create_est_timestamp,
               timestamp '2024-01-31 19:00:00' as etl_update_est_timestamp,
               coalesce(contains({ENVELOPE_SQL}, 'Deleted'), false) as is_deleted
        from events""",
)
def audit_struct(spark, sf):
    df = scd2.audit_struct(crud_events(spark, sf), AS_OF, delete_pattern="Deleted", type_col="envelope_type")
    return ntz(df.select("event_id", "etl_metadata_struct.*"))


@query(
    "source_ts_struct",
    """select o_orderkey, o_orderdate - interval 5 hour as create_est_timestamp,
              o_orderdate + interval 31 hour as update_est_timestamp from orders""",
)
def source_ts_struct(spark, sf):
    df = table(spark, sf, "orders")
    df = scd2.source_timestamps(df, "o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL '36' HOUR"))
    return df.select("o_orderkey", "source_timestamp_struct.*")


def with_context(df):
    k = prop()
    ids = {
        n: F.concat(F.lit(n + ":"), k)
        for n in ("deviceId", "sessionId", "tokenId", "actionId", "identityId", "accountId", "profileId", "agentId")
    }
    origin = F.struct(
        F.struct(F.col("event_type").alias("agentId")).alias("internalAgentAction"),
        F.struct(F.lit("user").alias("_")).alias("internalUserAction"),
        F.struct(F.lit("sys").alias("systemName"), k.alias("description")).alias("internalSystemAction"),
    )
    clock = F.struct(F.col("event_id").alias("epoch"), F.lit(1).alias("counter"))
    fields = [v.alias(n) for n, v in ids.items()]
    return df.withColumn("requestContext", F.struct(*fields, clock.alias("logicalClock"), origin.alias("origin")))


@query(
    "request_context",
    """select event_id, 'deviceId:' || (props->>'k') as device_id, 'agentId:' || (props->>'k') as agent_id,
              'profileId:' || (props->>'k') as profile_id, event_id as epoch, 1 as counter from events""",
)
def request_context(spark, sf):
    df = scd2.request_context(with_context(table(spark, sf, "events")))
    c = "request_context_struct"
    return df.select(
        "event_id", f"{c}.device_id", f"{c}.agent_id", f"{c}.profile_id", f"{c}.logical_clock.epoch", f"{c}.logical_clock.counter"
    )


@query(
    "request_context_nested",
    """select event_id, event_type as origin_agent, 'user' as origin_user, 'sys' as system_name,
              props->>'k' as description, 'tokenId:' || (props->>'k') as token_id, event_id as epoch from events""",
)
def request_context_nested(spark, sf):
    df = scd2.request_context_nested(with_context(table(spark, sf, "events")))
    c = "request_context"
    return df.select(
        "event_id",
        F.col(f"{c}.origin.internal_agent_action.agent_id").alias("origin_agent"),
        F.col(f"{c}.origin.internal_user_action._").alias("origin_user"),
        F.col(f"{c}.origin.internal_system_action.system_name").alias("system_name"),
        F.col(f"{c}.origin.internal_system_action.description").alias("description"),
        f"{c}.token_id",
        f"{c}.logical_clock.epoch",
    )
