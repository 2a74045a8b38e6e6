"""Nested values, lookups, device enrichment and point-in-time joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from histkit.catalog.registry import ntz, prop, query, table
from histkit.config import Interval, JobSpec, ReadSpec, WriteSpec
from histkit.functions import nested
from histkit.functions.casts import conform, null_defaults
from histkit.functions.times import local_time, open_end
from histkit.operators import joins as jn
from histkit.operators import scd2, segments
from histkit.plans import device, vehicle
from histkit.sources.files import materialize
from histkit.sources.watermark import newer_than


@query(
    "agent_supervisor",
    """
    with a as (select c_custkey as agent_key_id, c_name as agent_nm, nullif(c_mktsegment, 'BUILDING') as lob_cd,
                      c_custkey - 40 as supr_key, c_nationkey from customer)
    select a.agent_key_id, a.agent_nm, coalesce(a.lob_cd, 'Not Defined') as lob_cd, a.supr_key,
           coalesce(b.agent_nm, 'Not Defined') as supr_nm, coalesce(b.lob_cd, 'Not Defined') as supr_lob_cd
    from a left join a b on b.agent_key_id = a.supr_key
    """,
)
def agent_supervisor(spark, sf):
    agents = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("agent_key_id"),
        F.col("c_name").alias("agent_nm"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("lob_cd"),
        (F.col("c_custkey") - 40).alias("supr_key"),
    )
    rows = jn.self_parent(agents, {"supr_key": "agent_key_id"}, {"supr_nm": "agent_nm", "supr_lob_cd": "lob_cd"})
    return null_defaults(rows, {c: "Not Defined" for c in ("lob_cd", "supr_nm", "supr_lob_cd")})


@query(
    "watermark_extract",
    "select o_orderkey, o_orderdate from orders where o_orderdate > timestamp '1996-03-01 00:00:00'",
)
def watermark_extract(spark, sf):
    return newer_than(table(spark, sf, "orders"), "o_orderdate", "1996-03-01").select("o_orderkey", "o_orderdate")


@query(
    "enrich_latest_profile",
    """
    select c_custkey, c_nationkey, p.s_suppkey, p.s_name from customer left join (
      select * from supplier qualify row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) = 1
    ) p on p.s_nationkey = c_nationkey and c_acctbal > 0
    """,
)
def enrich_latest_profile(spark, sf):
    base = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("_nation")
    )
    best = [("s_acctbal", "desc"), ("s_suppkey", "asc")]
    look = jn.Lookup(
        table(spark, sf, "supplier"), {"_nation": "s_nationkey"}, {"s_suppkey": "s_suppkey", "s_name": "s_name"}, best=best
    )
    return jn.enrich(base, [look]).drop("_nation")


@query(
    "latest_snapshot",
    "select o_orderkey, o_orderdate from orders where date_trunc('month', o_orderdate) = "
    "(select max(date_trunc('month', o_orderdate)) from orders)",
)
def latest_snapshot(spark, sf):
    df = table(spark, sf, "orders").withColumn("snap", F.trunc("o_orderdate", "month"))
    return jn.latest_snapshot(df, "snap").select("o_orderkey", "o_orderdate")


@query(
    "not_in_keys",
    "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')",
)
def not_in_keys(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    some = done.unionByName(spark.range(1).select(F.lit(None).cast("bigint").alias("o_custkey")))
    return jn.not_in(table(spark, sf, "customer").select("c_custkey"), some, "c_custkey", "o_custkey")


@query(
    "semi_anti_keys",
    """select c_custkey, exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P') as has_pending
       from customer""",
)
def semi_anti_keys(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey")
    pending = table(spark, sf, "orders").where("o_orderstatus = 'P'").select("o_custkey")
    on = {"c_custkey": "o_custkey"}
    yes = jn.present_keys(customer, pending, on).withColumn("has_pending", F.lit(True))
    return yes.unionByName(jn.missing_keys(customer, pending, on).withColumn("has_pending", F.lit(False)))


@query(
    "array_lookup",
    """select event_id, case when event_type = 'purchase' then user_id::varchar end as oem_owner_id,
              'o' || (props->>'k') as oem_id, event_type as device_id, 'o' || (props->>'k') as first_id from events""",
)
def array_lookup(spark, sf):
    def one(source, value):
        return F.struct(F.lit(source).alias("source"), value.alias("id"))

    ids = F.array(
        one("oem", F.concat(F.lit("o"), prop())),
        one("device", F.col("event_type")),
        F.when(F.col("event_type") == "purchase", one("oemOwner", F.col("user_id").cast("string"))),
    )
    df = vehicle.element_ids(table(spark, sf, "events").withColumn("externalIds", ids))
    first = nested.first_element("externalIds")["id"].alias("first_id")
    return df.select("event_id", "oem_owner_id", "oem_id", "device_id", first)


TERMS_SQL = """
    select o_orderkey, [{'a': o_orderpriority, 'c': o_orderstatus}, {'a': '2.0', 'c': 'US'}, {'a': 'NA', 'c': null}] as terms,
           [strftime(o_orderdate, '%Y-%m-%d 00:00:00')::timestamp, timestamp '1999-05-05 12:00:00'] as times
    from orders"""


def _with_terms(df):
    def term(app, country, at):
        fields = {"appVersion": app, "countryCode": country, "consentType": F.lit("terms"), "language": F.lit("en")}
        fields |= {"version": F.lit("1"), "platform": F.lit("car"), "acceptedAt": at}
        return F.struct(*[v.cast("string").alias(n) for n, v in fields.items()])

    terms = F.array(
        term(F.col("o_orderpriority"), F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        term(F.lit("2.0"), F.lit("US"), F.lit("1999-05-05 12:00:00")),
        term(F.lit("NA"), F.lit(None), F.lit(None)),
    )
    return df.withColumn("legalTerms", terms)


@query(
    "array_struct_sorted",
    f"""
    select o_orderkey, array_to_string(list_sort(list_transform(terms, lambda x: x.a)), ',') as app_versions,
           array_to_string(list_transform(list_sort(terms), lambda x: x.a || ':' || coalesce(x.c, '-')), ',') as pairs,
           list_min(times) as first_accepted
    from ({TERMS_SQL})
    """,
)
def array_struct_sorted(spark, sf):
    df = vehicle.legal_terms(_with_terms(table(spark, sf, "orders")))
    pairs = F.transform(
        "legal_terms_array",
        lambda x: F.concat(x["app_version"], F.lit(":"), F.coalesce(x["country_code"], F.lit("-"))),
    )
    return ntz(
        df.select(
            "o_orderkey",
            F.array_join("legal_terms_struct.app_version", ",").alias("app_versions"),
            F.array_join(pairs, ",").alias("pairs"),
            nested.first_element("legal_terms_struct.accepted_est_timestamp").alias("first_accepted"),
        )
    )


ONEOF_SQL = """
    select event_id, event_type,
           case event_type when 'signup' then 'sms' when 'purchase' then 'zuora' when 'view' then 'charon'
                           when 'click' then 'internal' end as kind,
           case event_type when 'signup' then 'US_' || (props->>'k') when 'purchase' then null
                           when 'click' then 'MX_PR_' || user_id else 'unknown' end as ref
    from events"""


def oneof_source():
    kind = F.col("event_type")

    def alt(name, value):
        return F.when(kind == name, F.struct(value.cast("string").alias("externalReference")))

    return F.struct(
        alt("signup", F.concat(F.lit("US_"), prop())).alias("sms"),
        alt("purchase", F.lit(None)).alias("zuora"),
        alt("view", F.lit("c")).alias("charon"),
        alt("click", F.concat(F.lit("MX_PR_"), F.col("user_id").cast("string"))).alias("internal"),
    )


@query(
    "oneof_discriminator",
    f"""select event_id, kind as set_alternative, ref as reference,
               replace(replace(replace(ref, 'US_', ''), 'MX_', ''), 'PR_', '') as clean_reference,
               case when kind = 'sms' then 'message' end as variant
        from ({ONEOF_SQL})""",
)
def oneof_discriminator(spark, sf):
    df = table(spark, sf, "events").withColumn("source", oneof_source())
    ref = nested.oneof_value("source", ["sms", "zuora", "internal"], "externalReference", "unknown")
    return df.select(
        "event_id",
        nested.oneof_key("source", ["sms", "zuora", "charon", "internal"]).alias("set_alternative"),
        ref.alias("reference"),
        nested.strip_tokens(ref, ["US_", "MX_", "PR_", "NL_"]).alias("clean_reference"),
        nested.discriminator({"message": F.col("source.sms")}).alias("variant"),
    )


@query(
    "json_map_keys",
    "select event_id, 'k' as first_key, props->>'k' as first_value, props->>'k' as all_values from events",
)
def json_map_keys(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        nested.first_element(nested.json_keys("props")).alias("first_key"),
        nested.first_element(nested.json_values("props")).alias("first_value"),
        F.array_join(nested.json_values("props"), ",").alias("all_values"),
    )


@query(
    "vehicle_history",
    """
    with d as (select o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_orderpriority,
                      o_orderdate - interval 5 hour as vf,
                      case o_orderstatus when 'O' then 'delivered' when 'F' then 'nonDelivered' end as delivery_state
               from orders qualify row_number() over (partition by o_custkey, cast(o_orderdate - interval 5 hour as date)
                 order by o_orderdate desc, o_orderkey desc) = 1),
         c as (select *, lag(o_orderpriority) over w as p, lag(o_orderstatus) over w as s from d
               window w as (partition by o_custkey order by vf))
    select o_custkey as vehicle_id, 'P' as partner_name, 'x' || o_custkey as oem_id, 'automotive' as vehicle_type,
           o_orderpriority as vin, delivery_state,
           case when delivery_state = 'delivered' then 'sold' end as vehicle_sale_type,
           vf as valid_from_est_timestamp,
           coalesce(lead(vf) over (partition by o_custkey order by vf), timestamp '9999-12-31') as valid_to_est_timestamp,
           lead(vf) over (partition by o_custkey order by vf) is null as is_current
    from c where p is null or p <> o_orderpriority or s <> o_orderstatus
    """,
)
def vehicle_history(spark, sf):
    """Raw vehicle events through the whole vehicle job, rebuilt from all events."""
    s = F.col("o_orderstatus")
    state = F.struct(
        F.when(s == "O", F.struct(F.lit("sold").alias("vehicleType"))).alias("delivered"),
        F.when(s == "F", F.struct(F.lit("demo").alias("vehicleType"))).alias("nonDelivered"),
    )
    raw = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("vehicleId"),
        F.lit("P").alias("partner"),
        "o_orderkey",
        F.array(
            F.struct(F.lit("oem").alias("source"), F.concat(F.lit("x"), F.col("o_custkey").cast("string")).alias("id"))
        ).alias("externalIds"),
        F.struct(F.struct(F.col("o_orderpriority").alias("vin")).alias("automotive")).alias("vehicleAttributes"),
        F.struct(F.struct(state.alias("deliveryState")).alias("brand")).alias("specialAttributes"),
        F.array(
            F.struct(
                *[F.lit("t").alias(n) for n, t in vehicle.LEGAL_FIELDS.values() if t is None],
                F.lit("2000-01-01 00:00:00").alias("acceptedAt"),
            )
        ).alias("legalTerms"),
        F.lit("VehicleUpdated").alias("envelopeType"),
        F.col("o_orderdate").alias("envelopeTime"),
    )
    spec = JobSpec(
        ReadSpec(("vehicle_events",), ("vehicleId",), ("envelopeTime", "o_orderkey"), interval=Interval.DAY),
        WriteSpec("vehicle_history", ("vehicle_id",), target_order_by=("valid_from_est_timestamp",)),
    )
    rows = scd2.scd2_pipeline(raw, None, spec, "2002-01-01", lambda df: vehicle.project_vehicle(df, "brand"))
    return ntz(
        rows.select(
            "vehicle_id",
            "partner_name",
            "oem_id",
            "vehicle_type",
            "automotive_struct.vin",
            "special_attribute_struct.delivery_state",
            "special_attribute_struct.vehicle_sale_type",
            "valid_from_est_timestamp",
            "valid_to_est_timestamp",
            "is_current",
        )
    )


DEVICE_CTE = """
    dvc as (select c_custkey as device_id, c_custkey as vehicle_id, c_name as radio_id, c_mktsegment as device_platform,
                   timestamp '2001-01-01' + c_nationkey * interval 1 day as update_ts from customer),
    veh as (select c_custkey as vehicle_id, c_name as partner_name, c_nationkey as oem_owner_id, c_name as vin,
                   case when c_nationkey < 5 then 'nonDelivered' when c_nationkey < 20 then 'delivered' end as delivery_state,
                   case when c_acctbal > 2000 then timestamp '2000-02-02' + c_nationkey * interval 1 day end as accepted,
                   timestamp '1998-01-01' + c_nationkey * interval 1 day as valid_from, c_acctbal < 8000 as is_current from customer),
    prf as (select s_suppkey as profile_id, s_nationkey as device_id, s_nationkey as oem_profile_id, s_name as language_code,
                   timestamp '1997-01-01' + s_nationkey * interval 1 day as update_ts from supplier),
    sub as (select o_orderkey as subscription_id, o_custkey as device_id, o_custkey as identity_id,
                   case o_orderstatus when 'O' then 'active' when 'F' then 'finished' else 'closed' end as state,
                   case when o_orderstatus = 'P' then o_orderkey + 1 end as linked_id,
                   case when o_orderstatus = 'O' then 'b' || o_custkey end as beneficiary,
                   o_orderdate as start_ts, o_orderdate + interval 30 day as end_ts,
                   o_orderdate - interval 1 day as create_ts, o_orderdate + interval 2 day as update_ts from orders),
    j as (select dvc.device_id, dvc.radio_id, dvc.device_platform, dvc.update_ts as dvc_update, veh.*,
                 d.profile_id as demo_profile_id, d.update_ts as demo_update, o.profile_id as oem_owner_profile_id,
                 o.language_code as oem_owner_profile_language_code, o.update_ts as owner_update,
                 t.subscription_id as t_id, t.state as t_state, t.linked_id, t.start_ts as t_start, t.end_ts as t_end,
                 t.beneficiary, t.update_ts as t_update, l.state as l_state, l.create_ts as l_create, l.update_ts as l_update,
                 c.subscription_id as c_id, c.state as c_state, c.identity_id as c_identity, c.update_ts as c_update
          from dvc left join veh on veh.vehicle_id = dvc.vehicle_id
          left join prf d on d.device_id = dvc.device_id
          left join prf o on o.oem_profile_id = veh.oem_owner_id
          left join sub t on t.device_id = dvc.device_id
          left join sub l on l.subscription_id = t.linked_id
          left join sub c on c.identity_id = l.identity_id
          where veh.is_current
          qualify row_number() over (partition by dvc.device_id order by t.start_ts desc nulls last, c.start_ts desc nulls last,
            t.subscription_id nulls first, c.subscription_id nulls first, d.profile_id nulls first, o.profile_id nulls first) = 1),
    r as (select *, case when delivery_state = 'nonDelivered' then 'demo' when accepted is null then 'trial_eligible'
                 when t_state in ('closed', 'cancelled', 'finished') and linked_id is null then 'trial_expired'
                 when t_state not in ('closed', 'cancelled', 'finished') and accepted is not null then 'trial'
                 when c_state not in ('closed', 'cancelled', 'finished') then 'selfpay'
                 when c_state in ('closed', 'cancelled', 'finished') then 'end' else 'unknown' end as device_service_status
          from j)"""


def _device_joined(spark, sf):
    customer, supplier, orders = (table(spark, sf, t) for t in ("customer", "supplier", "orders"))

    def days(start, c):
        return F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(days=F.col(c))

    def times(create, update):
        return F.struct(create.alias("create_est_timestamp"), update.alias("update_est_timestamp"))

    nation, status = F.col("c_nationkey"), F.col("o_orderstatus")
    at = days("2001-01-01", "c_nationkey")
    devices = customer.select(
        F.col("c_custkey").alias("device_id"),
        F.struct(F.col("c_custkey").alias("vehicle_id"), F.col("c_name").alias("radio_id")).alias("vehicle_attribute_struct"),
        F.col("c_mktsegment").alias("device_platform"),
        times(at, at).alias("source_timestamp_struct"),
    )
    text = F.lit(None).cast("string")
    state = F.when(nation < 5, "nonDelivered").when(nation < 20, "delivered")
    accepted = F.when(F.col("c_acctbal") > 2000, F.array(days("2000-02-02", "c_nationkey"))).otherwise(
        F.array().cast("array<timestamp_ntz>")
    )
    vehicles = customer.select(
        F.col("c_custkey").alias("vehicle_id"),
        F.lit("automotive").alias("vehicle_type"),
        F.col("c_name").alias("partner_name"),
        nation.alias("oem_owner_id"),
        F.struct(F.col("c_name").alias("vin"), text.alias("make"), text.alias("model"), text.alias("year")).alias("automotive_struct"),
        F.struct(state.alias("delivery_state"), text.alias("vehicle_sale_type")).alias("special_attribute_struct"),
        text.alias("sale_country_code"),
        F.struct(accepted.alias("accepted_est_timestamp")).alias("legal_terms_struct"),
        days("1998-01-01", "c_nationkey").alias("valid_from_est_timestamp"),
        (F.col("c_acctbal") < 8000).alias("is_current"),
        F.struct(F.lit(False).alias("is_deleted")).alias("etl_metadata_struct"),
    )
    seen = days("1997-01-01", "s_nationkey")
    profiles = supplier.select(
        F.col("s_suppkey").alias("profile_id"),
        F.col("s_nationkey").alias("device_id"),
        F.col("s_nationkey").alias("oem_profile_id"),
        F.col("s_name").alias("language_code"),
        times(seen, seen).alias("source_timestamp_struct"),
    )
    start = F.col("o_orderdate")

    def plus(n):
        return start + F.expr(f"INTERVAL '{n}' DAY")

    def member(kind, value):
        return F.struct(F.lit(kind).alias("type"), value.alias("id"))

    who = F.concat(F.lit("b"), F.col("o_custkey").cast("string"))
    newest = orders.select(
        F.lit("2001-08-01").cast("date").alias("snapshot_est_date"),
        F.col("o_orderkey").alias("subscription_id"),
        F.col("o_custkey").alias("device_id"),
        F.col("o_custkey").alias("identity_id"),
        F.when(status == "O", "active").when(status == "F", "finished").otherwise("closed").alias("state"),
        F.when(status == "P", F.col("o_orderkey") + 1).alias("linked_to_subscription_id"),
        F.struct(start.alias("start_est_timestamp")).alias("subscription_timestamp_struct"),
        F.struct(plus(30).alias("phase_end_est_timestamp")).alias("current_phase_struct"),
        F.array(member("device", who), F.when(status == "O", member("identity", who))).alias("beneficiary_id_array_struct"),
        times(plus(-1), plus(2)).alias("source_timestamp_struct"),
    )
    stale = newest.withColumns({"snapshot_est_date": F.lit("2001-07-31").cast("date"), "state": F.lit("stale")})
    return device.join_device_sources(devices, vehicles, profiles, stale.unionByName(newest))


@query(
    "device_enrich",
    f"""with {DEVICE_CTE} select device_id, vehicle_id, partner_name, delivery_state, demo_profile_id, oem_owner_profile_id,
          oem_owner_profile_language_code, t_id as trial_id, linked_id, c_id as current_id, l_state as linked_state,
          least(valid_from, dvc_update, coalesce(owner_update, demo_update), c_update, l_update, t_update) as valid_from_est_timestamp
        from r""",
)
def device_enrich(spark, sf):
    joined = _device_joined(spark, sf)
    ids = joined.select(
        "device_id",
        F.col("_trial_subscription_id").alias("trial_id"),
        F.col("_trial_linked_to_subscription_id").alias("linked_id"),
        F.col("_current_subscription_id").alias("current_id"),
        F.col("_linked_state").alias("linked_state"),
    )
    rows = device.device_rows(joined).select(
        "device_id",
        "vehicle_id",
        "partner_name",
        "delivery_state",
        "demo_profile_id",
        "oem_owner_profile_id",
        "oem_owner_profile_language_code",
        "valid_from_est_timestamp",
    )
    return rows.join(ids, "device_id")


@query(
    "device_status",
    f"with {DEVICE_CTE} select device_id, device_service_status, linked_id is not null as has_linked_to_subscription from r",
)
def device_status(spark, sf):
    rows = device.device_rows(_device_joined(spark, sf))
    return rows.select("device_id", "device_service_status", "has_linked_to_subscription")


@query(
    "device_status_by_delivery",
    f"""with {DEVICE_CTE} select device_id, case when delivery_state = 'nonDelivered' then 'demo'
          when delivery_state = 'delivered' and accepted is null then 'trial_eligible'
          when delivery_state = 'delivered' and accepted is not null then 'trial'
          when t_state in ('closed', 'cancelled', 'finished') and linked_id is null then 'trial_expired'
          when c_state not in ('closed', 'cancelled', 'finished') then 'selfpay'
          when c_state in ('closed', 'cancelled', 'finished') then 'end' else 'unknown' end as device_service_status
        from r""",
)
def device_status_by_delivery(spark, sf):
    rows = device.device_rows(_device_joined(spark, sf), device.service_status_rules_by_delivery)
    return rows.select("device_id", "device_service_status")


@query(
    "delivered_only",
    f"""with {DEVICE_CTE}, x as (select *, delivery_state = 'delivered' as ok from r)
        select device_id, case when ok then t_id end as trial_subscription_id,
          case when ok then t_start end as trial_subscription_start_est_timestamp,
          case when ok then t_end end as trial_subscription_end_est_timestamp,
          case when ok then t_state end as trial_subscription_state,
          case when ok then beneficiary end as trial_identity_id,
          case when ok then coalesce(c_identity::varchar, beneficiary) end as identity_id,
          case when ok then linked_id end as linked_to_subscription_id,
          case when ok then l_state end as linked_to_subscription_state,
          case when ok then l_create end as linked_to_subscription_create_est_timestamp,
          case when ok then c_id end as current_subscription_id,
          case when ok then c_state end as current_subscription_state,
          (case when ok then beneficiary end) is null as is_anonymous_trial
        from x""",
)
def delivered_only(spark, sf):
    joined = _device_joined(spark, sf)
    rows = device.device_rows(joined.withColumn("_current_identity_id", F.col("_current_identity_id").cast("string")))
    names = [c for c in rows.columns if c.startswith(("trial_", "linked_to_", "current_sub"))]
    return rows.select("device_id", *names, "identity_id", "is_anonymous_trial")


SIGNUPS = """select user_id, event_id, props->>'k' as k, ts - interval 5 hour as vf,
                    coalesce(lead(ts - interval 5 hour) over (partition by user_id order by ts), timestamp '9999-12-31') as vt
             from events where event_type = 'signup'"""


@query(
    "pit_join",
    f"""
    with h as ({SIGNUPS}), s as (select event_id, user_id, event_type, ts - interval 5 hour as at from events)
    select s.*, h.event_id as signup_id, h.k as signup_k from s left join h
      on h.user_id = s.user_id and s.at >= h.vf and s.at < h.vt
    """,
)
def pit_join(spark, sf):
    return _signup_at(spark, sf, hot_rows=8)


@query(
    "pit_join_default",
    f"""
    with h as ({SIGNUPS}), s as (select event_id, user_id, event_type, ts - interval 5 hour as at from events)
    select s.*, h.event_id as signup_id, h.k as signup_k from s left join h
      on h.user_id = s.user_id and s.at >= h.vf and s.at < h.vt
    """,
)
def pit_join_default(spark, sf):
    return _signup_at(spark, sf)


@query(
    "pit_join_segments",
    f"""
    with h as ({SIGNUPS}), s as (select event_id, user_id, event_type, ts - interval 5 hour as at from events)
    select s.*, h.event_id as signup_id, h.k as signup_k from s left join h
      on h.user_id = s.user_id and s.at >= h.vf and s.at < h.vt
    """,
)
def pit_join_segments(spark, sf):
    """The same join by segmented scans."""
    log = table(spark, sf, "events").withColumns({"at": local_time("ts"), "k": prop()})
    signups = log.where("event_type = 'signup'").select("user_id", "event_id", "k", F.col("at").alias("vf"))
    history = segments.next_value(signups, ["user_id"], ["vf"], "vf", "vt", materialize)
    history = history.withColumn("vt", F.coalesce("vt", open_end(history.schema["vf"].dataType)))
    spine = log.select("event_id", "user_id", "event_type", "at")
    return segments.pit_join(spine, history, ["user_id"], "at", {"signup_id": "event_id", "signup_k": "k"}, "vf", "vt", materialize)


def _signup_at(spark, sf, **hot):
    log = table(spark, sf, "events").withColumns({"at": local_time("ts"), "k": prop()})
    signups = log.where("event_type = 'signup'").select(
        "user_id", "event_id", "k", F.col("at").alias("valid_from_est_timestamp")
    )
    history = scd2.build_validity(signups, ["user_id"], slice_by=F.date_trunc("MINUTE", "valid_from_est_timestamp"), **hot)
    history = materialize(history, "history")
    spine = log.select("event_id", "user_id", "event_type", "at")
    return jn.pit_join(
        spine,
        history,
        ["user_id"],
        "at",
        {"signup_id": "event_id", "signup_k": "k"},
        "valid_from_est_timestamp",
        "valid_to_est_timestamp",
        slice_by=F.date_trunc("MINUTE", "at"),
        **hot,
    )


@query(
    "conform_schema",
    "select event_id::varchar as event_id, round(value, 0)::integer as value, cast(ts as date) as ts, event_type from events",
)
def conform_schema(spark, sf):
    target = spark.createDataFrame([], "event_id string, value int, ts date, event_type string").schema
    df = table(spark, sf, "events").withColumn("value", F.round("value", 0))
    return conform(df, target)
