"""Filters, unions and latest-per-interval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histkit.catalog.registry import ntz, prop, query, table
from histkit.config import Interval
from histkit.functions.times import local_time
from histkit.operators import events as ev

COLS = ["event_id", "ts", "user_id", "event_type", "value"]
LOCAL_DAY = "cast(ts - interval 5 hour as date)"
SELECT = "select event_id, ts, user_id, event_type, value from events"


@query("events_by_date", f"{SELECT} where {LOCAL_DAY} between date '2024-01-05' and date '2024-01-20'")
def events_by_date(spark, sf):
    return ev.events_by_date(table(spark, sf, "events"), "2024-01-05", "2024-01-20", "ts").select(*COLS)


@query("events_until_date", f"{SELECT} where {LOCAL_DAY} < date '2024-01-16'")
def events_until_date(spark, sf):
    return ev.events_until(table(spark, sf, "events"), "2024-01-16", "ts").select(*COLS)


@query("events_from_day", f"{SELECT} where {LOCAL_DAY} = date '2024-01-10'")
def events_from_day(spark, sf):
    return ev.events_on(table(spark, sf, "events"), "2024-01-10", "ts").select(*COLS)


@query(
    "events_interval",
    f"{SELECT} where ts - interval 5 hour >= timestamp '2024-01-03 06:30:00' "
    "and ts - interval 5 hour <= timestamp '2024-01-25 18:15:30'",
)
def events_interval(spark, sf):
    df = table(spark, sf, "events")
    return ev.events_between(df, "2024-01-03 06:30:00", "2024-01-25 18:15:30", "ts").select(*COLS)


@query(
    "events_delay",
    f"{SELECT} where ts - interval 5 hour < timestamp '2024-01-29 12:00:00' - interval 48 hour",
)
def events_delay(spark, sf):
    return ev.events_before_delay(table(spark, sf, "events"), "2024-01-29 12:00:00", 48, "ts").select(*COLS)


@query(
    "events_utc_window",
    f"{SELECT} where ts >= timestamp '2024-01-02 00:00:00' and ts < timestamp '2024-01-28 13:00:00'",
)
def events_utc_window(spark, sf):
    df = table(spark, sf, "events")
    return ev.events_in_window(df, "2024-01-02 00:00:00", "2024-01-28 13:00:00", "ts").select(*COLS)


@query(
    "events_session_window",
    f"{SELECT} where ts >= timestamp '2024-01-04 00:00:00' and ts < timestamp '2024-01-21 07:00:00'",
)
def events_session_window(spark, sf):
    """The window comes from SQL session variables, as a notebook would set it."""
    for name, value in (("v_from_timestamp", "2024-01-04 00:00:00"), ("v_to_timestamp", "2024-01-21 07:45:00")):
        spark.sql(f"DECLARE OR REPLACE VARIABLE {name} TIMESTAMP_NTZ DEFAULT timestamp_ntz'{value}'")
    to_hour = F.date_trunc("HOUR", F.expr("v_to_timestamp")).cast("timestamp_ntz")
    return ev.events_in_window(table(spark, sf, "events"), F.expr("v_from_timestamp"), to_hour, "ts").select(*COLS)


@query(
    "incremental_hours",
    """
    with e as (select event_id, user_id, event_type, cast(ts as date) as date,
                      strftime(ts, '%H') as hour from events)
    select * from e where date > date '2024-01-15' or (date = date '2024-01-15' and hour >= '07')
    """,
)
def incremental_hours(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("date"), F.date_format("ts", "HH").alias("hour")
    )
    return ev.events_since_hour(df, "2024-01-15 07:42:00")


@query(
    "presence_filters",
    """
    with e as (
      select event_id, user_id, value < 5 as is_test,
             case props->>'k' when '0' then '' when '1' then null else props->>'k' end as individual_id,
             case when event_type = 'signup' then value end as signup,
             case when event_type = 'purchase' then value end as purchase,
             case when event_type = 'view' then value end as view_value
      from events)
    select event_id, user_id, individual_id, coalesce(signup, purchase, view_value) as amount
    from e
    where is_test = false and individual_id is not null and individual_id <> ''
      and (signup is not null or purchase is not null or view_value is not null)
    """,
)
def presence_filters(spark, sf):
    kinds = {"signup": "signup", "purchase": "purchase", "view": "view_value"}
    df = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        (F.col("value") < 5).alias("isTest"),
        F.when(prop() == "0", "").when(prop() == "1", F.lit(None)).otherwise(prop()).alias("individual_id"),
        F.struct(*[F.when(F.col("event_type") == k, F.col("value")).alias(n) for k, n in kinds.items()]).alias("source"),
    )
    rows = ev.require_nonblank(ev.drop_test(df), ["individual_id"])
    rows = ev.any_present(rows, [f"source.{n}" for n in kinds.values()])
    amount = F.coalesce(*[F.col(f"source.{n}") for n in kinds.values()])
    return rows.select("event_id", "user_id", "individual_id", amount.alias("amount"))


ENVELOPE_SQL = """case event_type when 'signup' then 'UserCreated' when 'error' then 'UserDeleted'
                  when 'view' then null else 'UserUpdated' end"""


def envelope_type():
    return (
        F.when(F.col("event_type") == "signup", "UserCreated")
        .when(F.col("event_type") == "error", "UserDeleted")
        .when(F.col("event_type") != "view", "UserUpdated")
    )


@query(
    "delete_flag",
    f"""select event_id, envelope_type, coalesce(contains(envelope_type, 'Deleted'), false) as is_removed
        from (select event_id, {ENVELOPE_SQL} as envelope_type from events)""",
)
def delete_flag(spark, sf):
    df = table(spark, sf, "events").select("event_id", envelope_type().alias("envelope_type"))
    return ev.with_delete_flag(df, "Deleted", "envelope_type")


@query(
    "curated_projection",
    "select event_id as id, user_id as identity_id, event_type as tenant_id, ts as envelope_time, "
    "ts - interval 5 hour as valid_from_est_timestamp, "
    "date_trunc('hour', ts - interval 5 hour) as valid_from_date_hour from events",
)
def curated_projection(spark, sf):
    df = table(spark, sf, "events")
    local = local_time("ts")
    return ntz(
        ev.project(
            df,
            {
                "id": "event_id",
                "identity_id": "user_id",
                "tenant_id": "event_type",
                "envelope_time": "ts",
                "valid_from_est_timestamp": local,
                "valid_from_date_hour": F.date_trunc("HOUR", local),
            },
        )
    )


@query(
    "union_missing_cols",
    """
    select event_id as id, user_id as key_id, ts as at, event_type as kind, cast(null as double) as amount from events
    union all
    select o_orderkey, o_custkey, o_orderdate, null, o_totalprice from orders
    """,
)
def union_missing_cols(spark, sf):
    a = ev.project(table(spark, sf, "events"), {"id": "event_id", "key_id": "user_id", "at": "ts", "kind": "event_type"})
    b = ev.project(
        table(spark, sf, "orders"), {"id": "o_orderkey", "key_id": "o_custkey", "at": "o_orderdate", "amount": "o_totalprice"}
    )
    return ev.union_all([a, b])


@query(
    "union_verbs",
    "select event_id, user_id, ts, event_type = 'error' as is_deleted from events",
)
def union_verbs(spark, sf):
    df = table(spark, sf, "events")
    kind = F.col("event_type")
    tables = {
        "created": df.where(kind == "signup"),
        "updated": df.where(~kind.isin("signup", "error")),
        "deleted": df.where(kind == "error"),
    }
    return ev.union_verbs({v: t.select("event_id", "user_id", "ts") for v, t in tables.items()})


@query(
    "spine_distinct",
    """
    select user_id as key_id, date_trunc('hour', ts - interval 5 hour) as valid_from_date_hour from events
    union
    select o_custkey, date_trunc('hour', o_orderdate - interval 5 hour) from orders
    """,
)
def spine_distinct(spark, sf):
    def side(name, key, ts):
        hour = F.date_trunc("HOUR", local_time(ts)).cast("timestamp_ntz")
        return table(spark, sf, name).select(F.col(key).alias("key_id"), hour.alias("valid_from_date_hour"))

    return ev.key_hour_spine([side("events", "user_id", "ts"), side("orders", "o_custkey", "o_orderdate")], "key_id")


@query(
    "union_distinct_maps",
    "select distinct user_id, event_type, props->>'k' as k from events",
)
def union_distinct_maps(spark, sf):
    df = table(spark, sf, "events").select(
        "user_id", "event_type", F.from_json("props", "MAP<STRING,STRING>").alias("m")
    )
    rows = ev.union_distinct([df, df.where(F.col("event_type") != "view")])
    return rows.select("user_id", "event_type", F.col("m")["k"].alias("k"))


def _latest(bucket: str) -> str:
    return f"""{SELECT} qualify row_number() over (
                 partition by user_id, {bucket} order by ts desc, event_id desc) = 1"""


def _latest_df(spark, sf, interval):
    df = table(spark, sf, "events")
    return ev.latest_per_interval(df, "ts", ["user_id"], ["ts", "event_id"], interval).select(*COLS)


@query("latest_per_day", _latest(LOCAL_DAY))
def latest_per_day(spark, sf):
    return _latest_df(spark, sf, Interval.DAY)


@query("latest_per_hour", _latest("date_trunc('hour', ts - interval 5 hour)"))
def latest_per_hour(spark, sf):
    return _latest_df(spark, sf, Interval.HOUR)


@query("latest_per_event", _latest("ts"))
def latest_per_event(spark, sf):
    return _latest_df(spark, sf, Interval.EVENT)


@query(
    "latest_mixed_order",
    f"""{SELECT} qualify row_number() over (partition by user_id, {LOCAL_DAY}
          order by date_trunc('hour', ts) desc, event_type = 'error' asc, ts desc, event_id asc) = 1""",
)
def latest_mixed_order(spark, sf):
    df = table(spark, sf, "events").withColumns(
        {"utc_hour": F.date_trunc("HOUR", "ts"), "is_deleted": F.col("event_type") == "error"}
    )
    order = [("utc_hour", "desc"), ("is_deleted", "asc"), ("ts", "desc"), ("event_id", "asc")]
    return ev.latest_per_interval(df, "ts", ["user_id"], order, Interval.DAY).select(*COLS)


@query(
    "top_rank",
    """select o_custkey, o_orderkey, o_totalprice from orders
       qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1""",
)
def top_rank(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ev.top_rank(df, ["o_custkey"], ["o_totalprice", ("o_orderkey", "asc")])


@query(
    "state_priority_top1",
    """select o_custkey, o_orderdate, o_orderkey, o_orderstatus from orders
       qualify row_number() over (partition by o_custkey, date_trunc('year', o_orderdate) order by
         case o_orderstatus when 'O' then 1 when 'P' then 2 else 3 end, o_orderdate desc, o_orderkey desc) = 1""",
)
def state_priority_top1(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    status = F.col("o_orderstatus")
    priority = F.when(status == "O", 1).when(status == "P", 2).otherwise(3)
    order = [priority.asc(), F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return ev.top_rank(df, ["o_custkey", F.year("o_orderdate")], order)
