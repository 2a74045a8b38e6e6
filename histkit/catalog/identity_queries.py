"""Staging, unified timeline, person resolution and identity history over the event log.

Event types stand for the five sources of an identity: signup - identity, purchase -
billing profile, view - household link, click - event-driven subscription, error -
legacy-driven subscription. ``k`` of the JSON column supplies attribute values, and small
values of it mark deletes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from histkit.catalog.join_queries import oneof_source
from histkit.catalog.registry import ntz, prop, query, table
from histkit.functions.times import local_time
from histkit.operators import resolve as rs
from histkit.operators import scd2
from histkit.operators import timeline as tl
from histkit.plans import identity
from histkit.sources.files import materialize

HIGH = "timestamp '9999-12-31 00:00:00'"
CUT = "2024-01-16 05:00:00"


def _text(prefix, cond=None):
    value = F.concat(F.lit(prefix), prop())
    return value if cond is None else F.when(cond, value)


def stages(spark, sf, where=None, hourly=False):
    """Staging histories of the five sources, or the hourly rows that they are made of."""
    log = table(spark, sf, "events")
    if where is not None:
        log = log.where(where)
    k, local = prop().cast("int"), local_time("ts")
    log = log.select("event_id", F.col("user_id").alias("identity_id"), "event_type", "ts", "props", (k < 10).alias("is_deleted"))

    def stage(kind, tracked, keep):
        rows = log.where(F.col("event_type") == kind).select(
            "event_id", "identity_id", "ts", "is_deleted", *[c.alias(n) for n, c in {**tracked, **keep}.items()]
        )
        make = scd2.hourly_rows if hourly else scd2.scd_stage
        return make(rows, "identity_id", list(tracked), ["ts", "is_deleted", "event_id"], "ts", keep=list(keep))

    linked = {"individual_id": _text("i", k >= 40), "account_id": F.when(k >= 20, k.cast("bigint"))}
    sub = {"subscription_id": F.col("event_id"), "source_reference": _text("r")}
    return {
        "idt": stage(
            "signup",
            {"email_address": _text("e"), "phone_number": _text("p", k > 50)},
            {"create_est_timestamp": local, "update_est_timestamp": local},
        ),
        "bp": stage(
            "purchase",
            {
                "first_name": _text("f", k >= 30),
                "last_name": _text("l"),
                "address_struct": F.struct(
                    *[(_text("c") if n == "city" else F.lit(None).cast("string")).alias(n) for n in rs.ADDRESS_FIELDS]
                ),
            },
            {"billing_profile_id": F.col("event_id")},
        ),
        "hh": stage("view", {"individual_id": _text("i"), "household_id": _text("h")}, {}),
        "event_sub": stage("click", linked, sub),
        "legacy_sub": stage("error", linked, sub),
    }


def stored_timeline(spark, sf):
    """The timeline written once, as a load with several steps after it does."""
    return materialize(tl.unified_timeline(stages(spark, sf)), "timeline")


def stage_sql(name: str, kind: str, tracked: dict, keep: dict, cond: str = "true") -> str:
    cols = ", ".join(f"{e} as {n}" for n, e in {**tracked, **keep}.items())
    lags = ", ".join(f"lag({n}) over w as b_{n}" for n in [*tracked, "is_deleted"])
    differs = " or ".join(f"b_{n} is distinct from {n}" for n in [*tracked, "is_deleted"])
    names = ", ".join([*tracked, *keep])
    return f"""
    {name}_h as (select user_id as identity_id, {cols}, k < 10 as is_deleted,
                   date_trunc('hour', ts - interval 5 hour) as vh, event_id as eid
                 from (select *, (props->>'k')::integer as k from events)
                 where event_type = '{kind}' and {cond}
                 qualify row_number() over (partition by user_id, date_trunc('hour', ts - interval 5 hour)
                   order by ts desc, k < 10 desc, event_id desc) = 1),
    {name}_c as (select *, lag(vh) over w as b_vh, {lags} from {name}_h window w as (partition by identity_id order by vh)),
    {name} as (select identity_id, {names}, is_deleted, vh as valid_from_date_hour,
                 coalesce(lead(vh) over (partition by identity_id order by vh), {HIGH}) as valid_to_date_hour
               from {name}_c where b_vh is null or {differs} or is_deleted)"""


_LINKED = {"individual_id": "case when k >= 40 then 'i' || k end", "account_id": "case when k >= 20 then k::bigint end"}
_SUB = {"subscription_id": "event_id", "source_reference": "'r' || k"}
_LOCAL = "ts - interval 5 hour"


def stages_sql(cond: str = "true", suffix: str = "") -> str:
    specs = [
        (
            "idt",
            "signup",
            {"email_address": "'e' || k", "phone_number": "case when k > 50 then 'p' || k end"},
            {"create_est_timestamp": _LOCAL, "update_est_timestamp": _LOCAL},
        ),
        (
            "bp",
            "purchase",
            {"first_name": "case when k >= 30 then 'f' || k end", "last_name": "'l' || k", "city": "'c' || k"},
            {"billing_profile_id": "event_id"},
        ),
        ("hh", "view", {"individual_id": "'i' || k", "household_id": "'h' || k"}, {}),
        ("event_sub", "click", _LINKED, _SUB),
        ("legacy_sub", "error", _LINKED, _SUB),
    ]
    return ",".join(stage_sql(n + suffix, kind, t, k, cond) for n, kind, t, k in specs)


def spine_sql(suffix: str = "") -> str:
    sources = ("idt", "bp", "hh", "event_sub", "legacy_sub")
    union = " union ".join(f"select identity_id, valid_from_date_hour from {s}{suffix}" for s in sources)
    joins = "\n".join(
        f"""left join {s}{suffix} {s} on {s}.identity_id = sp.identity_id
              and sp.valid_from_date_hour >= {s}.valid_from_date_hour and sp.valid_from_date_hour < {s}.valid_to_date_hour"""
        for s in sources
    )
    return f"from ({union}) sp {joins}"


CLASS_SQL = """case when first_name is not null and hh_individual_id is not null and is_billing_deleted <> true then 'billing'
                    when legacy_individual_id is not null and is_subscription_deleted <> true then 'legacy'
                    when legacy_account_id is not null then 'legacy-account' else 'identity' end"""

LINE_SQL = f"""
    line_raw as (
      select sp.identity_id, sp.valid_from_date_hour,
        coalesce(lead(sp.valid_from_date_hour) over (partition by sp.identity_id order by sp.valid_from_date_hour), {HIGH}) as valid_to_date_hour,
        case when idt.is_deleted = false then idt.email_address end as email_address,
        case when idt.is_deleted = false then idt.phone_number end as phone_number,
        idt.is_deleted as is_identity_deleted, idt.create_est_timestamp, idt.update_est_timestamp,
        idt.valid_from_date_hour as identity_valid_from, bp.billing_profile_id,
        case when bp.is_deleted = false then bp.first_name end as first_name,
        case when bp.is_deleted = false then bp.last_name end as last_name,
        case when bp.is_deleted = false then bp.city end as city,
        bp.is_deleted as is_billing_deleted, bp.valid_from_date_hour as billing_valid_from,
        case when hh.is_deleted = false then hh.individual_id end as hh_individual_id,
        case when hh.is_deleted = false then hh.household_id end as household_id,
        hh.is_deleted as is_household_deleted, hh.valid_from_date_hour as household_valid_from,
        coalesce(event_sub.subscription_id, legacy_sub.subscription_id) as subscription_id,
        coalesce(event_sub.source_reference, legacy_sub.source_reference) as legacy_subscription_id,
        coalesce(case when event_sub.is_deleted = false then event_sub.individual_id end,
                 case when legacy_sub.is_deleted = false then legacy_sub.individual_id end) as legacy_individual_id,
        coalesce(case when event_sub.is_deleted = false then event_sub.account_id end,
                 case when legacy_sub.is_deleted = false then legacy_sub.account_id end) as legacy_account_id,
        coalesce(event_sub.is_deleted, legacy_sub.is_deleted) as is_subscription_deleted,
        coalesce(event_sub.valid_from_date_hour, legacy_sub.valid_from_date_hour) as subscription_valid_from
      {{spine}}),
    line as (select *, coalesce(is_identity_deleted = false, false) and valid_to_date_hour = {HIGH} as is_current,
                    {CLASS_SQL} as id_source from line_raw)"""

FULL_LINE = f"with {stages_sql()}, {LINE_SQL.format(spine=spine_sql())}"
LINE_COLUMNS = """identity_id, valid_from_date_hour, valid_to_date_hour, is_current, email_address, phone_number, is_identity_deleted,
    create_est_timestamp, update_est_timestamp, identity_valid_from, billing_profile_id, first_name, last_name, city,
    is_billing_deleted, billing_valid_from, hh_individual_id, household_id, is_household_deleted, household_valid_from,
    subscription_id, legacy_subscription_id, legacy_individual_id, legacy_account_id, is_subscription_deleted,
    subscription_valid_from, id_source"""


def _flat_line(df):
    names = [c for c in df.columns if c != "address_struct"]
    return ntz(df.select(*names, F.col("address_struct.city").alias("city")))


@query(
    "timeline_ffill",
    f"""with {stages_sql()}
        select sp.identity_id, sp.valid_from_date_hour,
          coalesce(lead(sp.valid_from_date_hour) over (partition by sp.identity_id order by sp.valid_from_date_hour), {HIGH}) as valid_to_date_hour,
          idt.email_address, bp.first_name, hh.individual_id, event_sub.subscription_id as event_sub_id,
          legacy_sub.subscription_id as legacy_sub_id, legacy_sub.is_deleted as legacy_deleted
        {spine_sql()}""",
)
def timeline_ffill(spark, sf):
    sources = {n: (df, [*tl.SOURCE_COLUMNS[n], "is_deleted"]) for n, df in stages(spark, sf).items()}
    rows = tl.timeline(sources, "identity_id")
    return ntz(
        rows.select(
            "identity_id",
            "valid_from_date_hour",
            "valid_to_date_hour",
            "idt.email_address",
            "bp.first_name",
            "hh.individual_id",
            F.col("event_sub.subscription_id").alias("event_sub_id"),
            F.col("legacy_sub.subscription_id").alias("legacy_sub_id"),
            F.col("legacy_sub.is_deleted").alias("legacy_deleted"),
        )
    )


@query("unified_timeline", f"{FULL_LINE} select {LINE_COLUMNS} from line")
def unified_timeline(spark, sf):
    return _flat_line(tl.unified_timeline(stages(spark, sf)))


@query("source_class", f"{FULL_LINE} select id_source, count(*) as row_count from line group by id_source")
def source_class(spark, sf):
    line = tl.unified_timeline(stages(spark, sf))
    return line.groupBy("id_source").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "masked_on_delete",
    f"""{FULL_LINE} select identity_id, valid_from_date_hour, is_identity_deleted, email_address, is_billing_deleted, first_name
        from line where is_identity_deleted or is_billing_deleted""",
)
def masked_on_delete(spark, sf):
    line = tl.unified_timeline(stages(spark, sf)).where("is_identity_deleted or is_billing_deleted")
    return ntz(
        line.select(
            "identity_id", "valid_from_date_hour", "is_identity_deleted", "email_address", "is_billing_deleted", "first_name"
        )
    )


def _as_target(line):
    """History rows of an earlier load, as far as a delta load reads them."""
    individual = F.when(F.col("id_source") == "billing", F.col("hh_individual_id")).when(
        F.col("id_source") == "legacy", F.col("legacy_individual_id")
    )
    return line.select(
        "identity_id",
        F.col("valid_from_date_hour").alias("valid_from_est_timestamp"),
        F.col("valid_to_date_hour").alias("valid_to_est_timestamp"),
        "email_address",
        "phone_number",
        F.col("create_est_timestamp").alias("created_est_timestamp"),
        F.col("is_identity_deleted").alias("is_deleted"),
        "first_name",
        "last_name",
        "address_struct",
        individual.alias("individual_id"),
        F.col("id_source").alias("individual_id_source"),
        F.struct(*[F.col(c).alias(f) for f, c in tl.INFO_FIELDS.items()]).alias("additional_info_struct"),
    )


DELTA_SQL = f"""
    with {stages_sql(f"ts < timestamp '{CUT}'")}, {LINE_SQL.format(spine=spine_sql())},
    u as (select *, case id_source when 'billing' then hh_individual_id when 'legacy' then legacy_individual_id end as individual_id from line),
    {stages_sql(f"ts >= timestamp '{CUT}'", "_d")},
    d as (
      select sp.identity_id, sp.valid_from_date_hour,
        case when idt.is_deleted then sp.valid_from_date_hour else
          coalesce(lead(sp.valid_from_date_hour) over (partition by sp.identity_id order by sp.valid_from_date_hour), {HIGH}) end as valid_to_date_hour,
        coalesce(idt.is_deleted = false, false) as alive,
        coalesce(idt.email_address, u.email_address) as email_address, coalesce(idt.phone_number, u.phone_number) as phone_number,
        coalesce(idt.is_deleted, u.is_identity_deleted) as is_identity_deleted,
        coalesce(idt.create_est_timestamp, u.create_est_timestamp) as create_est_timestamp, idt.update_est_timestamp,
        coalesce(idt.valid_from_date_hour, u.identity_valid_from) as identity_valid_from, bp.billing_profile_id,
        coalesce(bp.first_name, u.first_name) as first_name, coalesce(bp.last_name, u.last_name) as last_name,
        coalesce(bp.city, u.city) as city, coalesce(bp.is_deleted, u.is_billing_deleted) as is_billing_deleted,
        coalesce(bp.valid_from_date_hour, u.billing_valid_from) as billing_valid_from,
        coalesce(hh.individual_id, case when u.id_source = 'billing' then u.individual_id end) as hh_individual_id, hh.household_id,
        coalesce(hh.is_deleted, u.is_household_deleted) as is_household_deleted,
        coalesce(hh.valid_from_date_hour, u.household_valid_from) as household_valid_from,
        coalesce(event_sub.subscription_id, legacy_sub.subscription_id) as subscription_id,
        coalesce(event_sub.source_reference, legacy_sub.source_reference) as legacy_subscription_id,
        coalesce(event_sub.individual_id, legacy_sub.individual_id, case when u.id_source = 'legacy' then u.individual_id end) as legacy_individual_id,
        coalesce(event_sub.account_id, legacy_sub.account_id, u.legacy_account_id) as legacy_account_id,
        coalesce(event_sub.is_deleted, legacy_sub.is_deleted, u.is_subscription_deleted) as is_subscription_deleted,
        coalesce(event_sub.valid_from_date_hour, u.subscription_valid_from) as subscription_valid_from
      {spine_sql("_d")}
      left join u on u.identity_id = sp.identity_id and sp.valid_from_date_hour >= u.valid_from_date_hour
        and sp.valid_from_date_hour < u.valid_to_date_hour),
    e as (select *, alive and valid_to_date_hour = {HIGH} as is_current, {CLASS_SQL} as id_source from d)
    select {LINE_COLUMNS} from e"""


@query("timeline_delta_fallback", DELTA_SQL)
def timeline_delta_fallback(spark, sf):
    early = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")
    target = _as_target(tl.unified_timeline(stages(spark, sf, early)))
    return _flat_line(tl.unified_timeline_delta(stages(spark, sf, ~early), target))


def _legacy_tables(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    named = F.concat(F.lit("i"), F.col("o_custkey").cast("string"))
    devices = orders.select(
        F.col("o_orderkey").alias("subscription_id"),
        F.when(F.col("o_orderstatus") != "F", named).alias("individual_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").alias("update_est_timestamp"),
    )
    text = F.lit(None).cast("string")
    individuals = customer.select(
        F.concat(F.lit("i"), F.col("c_custkey").cast("string")).alias("individual_id"),
        F.concat(F.lit("h"), F.col("c_nationkey").cast("string")).alias("household_id"),
        F.concat(F.lit("e"), F.col("c_custkey").cast("string")).alias("best_email_address"),
        F.col("c_mktsegment").alias("best_address_city"),
        *[text.alias(f"best_address_{c}") for c in ("state", "zip_code", "line1", "line2")],
        F.lit("USA").alias("best_address_country_code"),
        F.concat(F.lit("f"), F.col("c_custkey").cast("string")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        text.alias("best_phone_number"),
        (F.lit("2000-01-01 10:20:30").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("c_nationkey"))).alias(
            "update_est_timestamp"
        ),
    )
    address = rs.legacy_address()
    known = individuals.where(F.length("household_id") == 2).select(
        F.concat(F.lit("old-"), F.col("individual_id")).alias("person_id"),
        F.lit("legacy").alias("source"),
        "individual_id",
        "household_id",
        "best_email_address",
        address.alias("best_address_struct"),
        F.col("first_name").alias("best_first_name"),
        F.col("last_name").alias("best_last_name"),
        "best_phone_number",
        F.lit("active").alias("state"),
        text.alias("primary_identity_id").cast("bigint").alias("primary_identity_id"),
        F.substring("individual_id", 2, 20).cast("bigint").alias("primary_legacy_account_id"),
    )
    return devices, individuals, known


LEGACY_SQL = """
    dev as (select o_orderkey as subscription_id, case when o_orderstatus <> 'F' then 'i' || o_custkey end as individual_id,
                   o_custkey as account_id, o_orderdate as updated from orders),
    ind as (select 'i' || c_custkey as individual_id, 'h' || c_nationkey as household_id, 'e' || c_custkey as best_email_address,
                   c_mktsegment as city, 'f' || c_custkey as first_name, c_name as last_name,
                   timestamp '2000-01-01 10:20:30' + c_nationkey * interval 1 hour as updated from customer),
    p0 as (select 'old-' || individual_id as person_id, 'legacy' as source, individual_id, household_id, best_email_address,
                  city, 'US' as country, first_name as best_first_name, last_name as best_last_name, null::varchar as best_phone_number,
                  'active' as state, null::bigint as primary_identity_id, substr(individual_id, 2)::bigint as primary_legacy_account_id
           from ind where length(household_id) = 2),
    b as (select sha256('individual|' || hh_individual_id) as person_id, 'primary' as source, hh_individual_id as individual_id,
                 household_id, email_address as best_email_address, city, null::varchar as country, first_name as best_first_name,
                 last_name as best_last_name, phone_number as best_phone_number, identity_id as primary_identity_id
          from line where id_source = 'billing'
          qualify row_number() over (partition by hh_individual_id order by update_est_timestamp desc nulls last,
            valid_from_date_hour desc, identity_id desc) = 1),
    p1 as (select coalesce(p0.person_id, b.person_id) as person_id, coalesce(b.source, p0.source) as source,
                  coalesce(p0.individual_id, b.individual_id) as individual_id,
                  case when b.person_id is null then p0.household_id else b.household_id end as household_id,
                  case when b.person_id is null then p0.best_email_address else b.best_email_address end as best_email_address,
                  case when b.person_id is null then p0.city else b.city end as city,
                  case when b.person_id is null then p0.country else b.country end as country,
                  case when b.person_id is null then p0.best_first_name else b.best_first_name end as best_first_name,
                  case when b.person_id is null then p0.best_last_name else b.best_last_name end as best_last_name,
                  case when b.person_id is null then p0.best_phone_number else b.best_phone_number end as best_phone_number,
                  'active' as state,
                  case when b.person_id is null then p0.primary_identity_id else b.primary_identity_id end as primary_identity_id,
                  case when b.person_id is null then p0.primary_legacy_account_id end as primary_legacy_account_id,
                  case when b.person_id is null then 'keep' when p0.person_id is null then 'insert' else 'update' end as action
           from p0 full join b on p0.individual_id = b.individual_id),
    p2 as (select * exclude (action) from p1 union all
           select sha256('individual|' || l.individual_id), 'legacy', l.individual_id, ind.household_id, ind.best_email_address, ind.city,
                  'US', ind.first_name, ind.last_name, null, 'active', null, l.account_id
           from (select * from dev where individual_id is not null and account_id is not null
                 qualify row_number() over (partition by individual_id order by updated desc, account_id desc) = 1) l
           join ind using (individual_id) where individual_id not in (select individual_id from p1)),
    p3 as (select * from p2 union all
           select sha256('account|' || account_id), 'legacy-account', null, null, null, null, null, null, null, null, 'active', null, account_id
           from (select distinct account_id from dev where individual_id is null)),
    p4 as (select * from p3 union all
           select sha256('identity|' || identity_id), 'identity', null, null, email_address, null, null, null, null, phone_number, 'active', identity_id, null
           from (select * from line where id_source = 'identity'
                 qualify row_number() over (partition by identity_id order by valid_from_date_hour desc) = 1))"""

PERSON_COLUMNS = """person_id, source, individual_id, household_id, best_email_address, city, country, best_first_name,
    best_last_name, best_phone_number, state, primary_identity_id, primary_legacy_account_id"""


def _flat_person(df):
    names = [c for c in df.columns if c != "best_address_struct"]
    return df.select(*names, F.col("best_address_struct.city").alias("city"), F.col("best_address_struct.country").alias("country"))


@query("person_primary", f"{FULL_LINE}, {LEGACY_SQL} select {PERSON_COLUMNS}, action from p1")
def person_primary(spark, sf):
    _, _, known = _legacy_tables(spark, sf)
    merged = rs.upsert_primary_persons(known, tl.unified_timeline(stages(spark, sf)))
    return _flat_person(merged.withColumnRenamed("_action", "action"))


@query("person_insert_missing", f"{FULL_LINE}, {LEGACY_SQL} select {PERSON_COLUMNS} from p4")
def person_insert_missing(spark, sf):
    devices, individuals, known = _legacy_tables(spark, sf)
    line = stored_timeline(spark, sf)
    return _flat_person(rs.resolve_persons(known, line, devices, individuals))


@query("person_insert_twice", f"{FULL_LINE}, {LEGACY_SQL} select {PERSON_COLUMNS} from p4")
def person_insert_twice(spark, sf):
    """Resolving the same load again adds nobody and changes nothing."""
    devices, individuals, known = _legacy_tables(spark, sf)
    line = stored_timeline(spark, sf)
    once = materialize(rs.resolve_persons(known, line, devices, individuals), "person")
    return _flat_person(rs.resolve_persons(once, line, devices, individuals))


def _flag(a: str, b: str) -> str:
    return f"case when {a} is null and {b} is null then null when {a} = {b} then true else false end"


HISTORY_SQL = f"""
    hist as (
      select l.*, p.person_id, p.best_first_name, p.best_last_name, p.best_email_address, p.best_phone_number,
             p.city as best_city, p.country as best_country, p.primary_identity_id, p.primary_legacy_account_id, p.person_id is not null as hit
      from line l left join p4 p on
        (l.id_source = 'billing' and p.individual_id = l.hh_individual_id)
        or (l.id_source = 'legacy' and p.individual_id = l.legacy_individual_id)
        or (l.id_source = 'legacy-account' and p.source = 'legacy-account' and p.primary_legacy_account_id = l.legacy_account_id)
        or (l.id_source = 'identity' and p.source = 'identity' and p.primary_identity_id = l.identity_id)),
    hist2 as (select *, lag(person_id) over (partition by identity_id order by valid_from_date_hour) as prior from hist)"""


@query(
    "unified_history",
    f"""{FULL_LINE}, {LEGACY_SQL}, {HISTORY_SQL}
    select identity_id, person_id,
           case id_source when 'billing' then hh_individual_id when 'legacy' then legacy_individual_id end as individual_id,
           id_source as individual_id_source, email_address, first_name, last_name, phone_number, city,
           create_est_timestamp as created_est_timestamp, valid_from_date_hour as valid_from_est_timestamp,
           valid_to_date_hour as valid_to_est_timestamp, is_current, is_identity_deleted as is_deleted,
           billing_profile_id, subscription_id, legacy_subscription_id,
           identity_valid_from as identity_valid_from_est_timestamp, billing_valid_from as billing_profile_valid_from_est_timestamp,
           household_valid_from as household_link_valid_from_est_timestamp, subscription_valid_from as subscription_valid_from_est_timestamp,
           is_billing_deleted as is_billing_profile_deleted, is_household_deleted as is_household_link_deleted, is_subscription_deleted,
           legacy_account_id as linked_legacy_account_id, case when prior is distinct from person_id then prior end as prior_person_id,
           timestamp '2024-01-31 19:00:00' as etl_create_est_timestamp, timestamp '2024-01-31 19:00:00' as etl_update_est_timestamp
    from hist2""",
)
def unified_history(spark, sf):
    rows = _history(spark, sf)
    return ntz(
        rows.select(
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
            "additional_info_struct.*",
            "prior_person_struct.prior_person_id",
            "etl_metadata_struct.*",
        )
    )


def _history(spark, sf):
    devices, individuals, known = _legacy_tables(spark, sf)
    line = stored_timeline(spark, sf)
    return rs.identity_history(line, rs.resolve_persons(known, line, devices, individuals), as_of="2024-02-01 00:00:00")


@query(
    "prior_person",
    f"""{FULL_LINE}, {LEGACY_SQL}, {HISTORY_SQL}
    select identity_id, valid_from_date_hour as valid_from_est_timestamp, person_id,
           case when prior is distinct from person_id then prior end as prior_person_id,
           case when prior is distinct from person_id and prior is not null then valid_from_date_hour end as change_est_timestamp
    from hist2""",
)
def prior_person(spark, sf):
    return ntz(
        _history(spark, sf).select(
            "identity_id",
            "valid_from_est_timestamp",
            "person_id",
            "prior_person_struct.prior_person_id",
            "prior_person_struct.change_est_timestamp",
        )
    )


FLAG_NAMES = ["is_best_first_name", "is_best_last_name", "is_best_email_address", "is_best_phone_number", "is_best_address", "is_primary"]


@query(
    "best_flags",
    f"""{FULL_LINE}, {LEGACY_SQL}, {HISTORY_SQL}
    select identity_id, valid_from_date_hour as valid_from_est_timestamp,
      {_flag("first_name", "best_first_name")} as is_best_first_name, {_flag("last_name", "best_last_name")} as is_best_last_name,
      {_flag("email_address", "best_email_address")} as is_best_email_address,
      {_flag("phone_number", "best_phone_number")} as is_best_phone_number,
      case when not addr and not best_addr then null when addr and best_addr and city = best_city and best_country is null then true else false end as is_best_address,
      case when id_source = 'legacy-account' then {_flag("legacy_account_id", "primary_legacy_account_id")}
           else {_flag("identity_id", "primary_identity_id")} end as is_primary
    from (select *, is_billing_deleted is not distinct from false as addr,
                 hit and (best_first_name is not null or best_last_name is not null or best_city is not null) as best_addr from hist2)""",
)
def best_flags(spark, sf):
    return ntz(_history(spark, sf).select("identity_id", "valid_from_est_timestamp", *FLAG_NAMES))


@query(
    "legacy_account_rows",
    f"""{FULL_LINE}, {LEGACY_SQL},
    n as (select * from dev where individual_id is not null
          qualify row_number() over (partition by account_id order by updated desc, individual_id desc) = 1),
    m as (select * from dev where individual_id is null
          qualify row_number() over (partition by account_id order by updated desc) = 1)
    select 'A:' || n.account_id as unified_identity_id, 'legacy' as source, n.account_id as legacy_account_id, p.person_id,
           n.individual_id, 'legacy' as individual_id_source, ind.best_email_address as email_address, ind.first_name,
           {_flag("ind.first_name", "p.best_first_name")} as is_best_first_name,
           {_flag("n.account_id", "p.primary_legacy_account_id")} as is_primary,
           date_trunc('hour', ind.updated) as valid_from_est_timestamp, {HIGH} as valid_to_est_timestamp, true as is_current
    from n join ind using (individual_id) left join p4 p on p.individual_id = n.individual_id
    union all
    select 'A:' || m.account_id, 'legacy', m.account_id, p.person_id, null, null, null, null, null,
           {_flag("m.account_id", "p.primary_legacy_account_id")}, date_trunc('hour', m.updated), {HIGH}, true
    from m left join p4 p on p.source = 'legacy-account' and p.primary_legacy_account_id = m.account_id""",
)
def legacy_account_rows(spark, sf):
    devices, individuals, known = _legacy_tables(spark, sf)
    line = stored_timeline(spark, sf)
    person = materialize(rs.resolve_persons(known, line, devices, individuals), "person")
    rows = rs.legacy_account_history(devices, individuals, person)
    return ntz(
        rows.select(
            "unified_identity_id",
            "source",
            "legacy_account_id",
            "person_id",
            "individual_id",
            "individual_id_source",
            "email_address",
            "first_name",
            "is_best_first_name",
            "is_primary",
            "valid_from_est_timestamp",
            "valid_to_est_timestamp",
            "is_current",
        )
    )


def _raw_verbs(df, kind_created="signup", kind_deleted="error"):
    """Split raw events into one table per verb."""
    kind = F.col("event_type")
    return {
        "created": df.where(kind == kind_created),
        "updated": df.where(~kind.isin(kind_created, kind_deleted)),
        "deleted": df.where(kind == kind_deleted),
    }


def raw_stage_sql(cols: dict, tracked: list, order: str, where: str = "true", keep: tuple = ()) -> str:
    names = ", ".join([*tracked, *keep])
    exprs = ", ".join(f"{e} as {n}" for n, e in cols.items())
    lags = ", ".join(f"lag({n}) over w as b_{n}" for n in [*tracked, "is_deleted"])
    differs = " or ".join(f"b_{n} is distinct from {n}" for n in [*tracked, "is_deleted"])
    return f"""
    with e as (select user_id as identity_id, {exprs}, ts, event_id, event_type = 'error' as is_deleted,
                      date_trunc('hour', ts - interval 5 hour) as vh
               from (select *, (props->>'k')::integer as k from events) where value >= 5
                 and ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-30'),
         h as (select * from e where {where} qualify row_number() over (partition by identity_id, vh order by {order}) = 1),
         c as (select *, lag(vh) over w as b_vh, {lags} from h window w as (partition by identity_id order by vh)),
         v as (select *, coalesce(lead(vh) over (partition by identity_id order by vh), {HIGH}) as vt from c
               where b_vh is null or {differs} or is_deleted)
    select identity_id, {names}, vh as valid_from_date_hour, vt as valid_to_date_hour,
           not is_deleted and vt = {HIGH} as is_current, is_deleted from v"""


WINDOW = ("2024-01-02", "2024-01-30")


def _envelope(spark, sf):
    return table(spark, sf, "events").select(
        "*",
        F.col("user_id").alias("identityId"),
        (F.col("value") < 5).alias("isTest"),
        F.col("ts").alias("envelopeTime"),
        F.col("ts").alias("createdAt"),
        F.col("ts").alias("lastUpdatedAt"),
        prop().cast("int").alias("k"),
    )


@query(
    "stage_identity",
    raw_stage_sql(
        {"email_address": "case when k < 50 then 'h' || k else 'c' || k end", "phone_number": "'p' || k"},
        ["email_address", "phone_number"],
        "ts desc, is_deleted desc, email_address desc",
    ),
)
def stage_identity(spark, sf):
    raw = _envelope(spark, sf).withColumns(
        {
            "handle": F.struct(_text("h", F.col("k") < 50).alias("emailAddress")),
            "contact": F.struct(_text("c").alias("emailAddress"), _text("p").alias("PhoneNumber")),
        }
    )
    return ntz(identity.identity_stage(_raw_verbs(raw), *WINDOW).drop("create_est_timestamp", "update_est_timestamp"))


@query(
    "stage_billing",
    raw_stage_sql(
        {"tenant_id": "event_type", "first_name": "'f' || k", "last_name": "'l'", "city": "'c' || k"},
        ["tenant_id", "first_name", "last_name", "city"],
        "ts desc, is_deleted asc, event_id desc",
    ),
)
def stage_billing(spark, sf):
    text = F.lit(None).cast("string")
    address = {"city": _text("c"), "state": text, "zipCode": text, "addressLine1": text, "addressLine2": text, "country": text}
    raw = _envelope(spark, sf).withColumns(
        {
            "id": F.col("event_id"),
            "tenant": F.col("event_type"),
            "billingProfileName": F.struct(
                F.struct(_text("f").alias("firstName"), F.lit("l").alias("lastName")).alias("firstAndLastName")
            ),
            "serviceAddress": F.struct(*[v.alias(n) for n, v in address.items()]),
        }
    )
    rows = identity.billing_stage(_raw_verbs(raw), *WINDOW)
    return ntz(rows.withColumn("city", F.col("address_struct.city")).drop("address_struct", "billing_profile_id"))


@query(
    "stage_household",
    raw_stage_sql(
        {"individual_id": "case when k < 5 then '' when k > 5 then 'i' || k end", "household_id": "'h' || k"},
        ["individual_id", "household_id"],
        "ts desc, is_deleted desc, individual_id desc",
        "individual_id is not null and individual_id <> ''",
    ),
)
def stage_household(spark, sf):
    k = F.col("k")
    raw = _envelope(spark, sf).withColumns(
        {"individualId": F.when(k < 5, "").when(k > 5, _text("i")), "householdId": _text("h")}
    )
    return ntz(identity.household_stage(_raw_verbs(raw), *WINDOW))


def subscription_sql(event_cond: str, legacy_cond: str) -> str:
    return f"""
    with ev as (select event_id as subscription_id, user_id as identity_id,
                       case when value > 60 then 'active' when value > 30 then 'paused' else 'new' end as state,
                       case event_type when 'signup' then (props->>'k') when 'click' then user_id::varchar when 'purchase' then null
                                       else 'unknown' end as ref,
                       ts, value < 15 as is_deleted, date_trunc('hour', ts - interval 5 hour) as vh
                from events where value >= 5 and event_type <> 'error' and {event_cond}),
         dim as (select c_custkey::varchar as short_id, c_custkey as legacy_id, c_nationkey as key_id from customer where c_acctbal > 0),
         leg as (select o_custkey as legacy_id, case when o_orderstatus <> 'F' then 'i' || o_orderkey end as individual_id,
                        o_orderkey as account_id, o_orderdate as updated from orders where {legacy_cond}),
         ind as (select 'i' || o_orderkey as individual_id, 'h' || o_custkey as household_id from orders),
         h as (select ev.*, leg.individual_id, leg.account_id, ind.household_id
               from leg join dim using (legacy_id) join ev on dim.short_id = ev.ref
               left join ind on ind.individual_id = leg.individual_id
               qualify row_number() over (partition by ev.identity_id, ev.vh order by ts desc, is_deleted desc,
                 case state when 'active' then 1 when 'paused' then 2 else 3 end, key_id desc, updated desc,
                 leg.account_id desc, subscription_id desc) = 1),
         c as (select *, lag(vh) over w as b_vh, lag(account_id) over w as b1, lag(individual_id) over w as b2, lag(is_deleted) over w as b3
               from h window w as (partition by identity_id order by vh))
    select identity_id, account_id, individual_id, subscription_id, ref as source_reference, household_id,
           vh as valid_from_date_hour, coalesce(lead(vh) over (partition by identity_id order by vh), {HIGH}) as valid_to_date_hour,
           not is_deleted and lead(vh) over (partition by identity_id order by vh) is null as is_current, is_deleted
    from c where b_vh is null or b1 is distinct from account_id or b2 is distinct from individual_id
       or b3 is distinct from is_deleted or is_deleted"""


def _subscription_stage(spark, sf, driven_by, window):
    raw = _envelope(spark, sf).withColumns(
        {
            "subscriptionId": F.col("event_id"),
            "owner": F.struct(F.col("user_id").alias("identityId")),
            "state": F.when(F.col("value") > 60, "active").when(F.col("value") > 30, "paused").otherwise("new"),
            "source": oneof_source(),
        }
    )
    gone = F.col("value") < 15
    verbs = {"created": raw.where(~gone), "deleted": raw.where(gone)}
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    subscriptions = customer.select(
        F.col("c_custkey").cast("string").alias("short_sbscrptn_id"),
        F.col("c_custkey").alias("sms_sbscrptn_id"),
        F.col("c_nationkey").alias("sbscrptn_key_id"),
        F.when(F.col("c_acctbal") > 0, "Y").otherwise("N").alias("is_latest_rec_ind"),
    )
    individual = F.concat(F.lit("i"), F.col("o_orderkey").cast("string"))
    legacy = orders.select(
        F.col("o_custkey").alias("subscription_id"),
        F.when(F.col("o_orderstatus") != "F", individual).alias("individual_id"),
        F.col("o_orderkey").alias("account_id"),
        F.struct(F.col("o_orderdate").alias("etl_update_est_timestamp")).alias("etl_metadata_struct"),
    )
    household = F.concat(F.lit("h"), F.col("o_custkey").cast("string"))
    individuals = orders.select(individual.alias("individual_id"), household.alias("household_id"))
    return ntz(identity.subscription_stage(verbs, subscriptions, legacy, individuals, *window, driven_by))


@query(
    "stage_event_subscription",
    subscription_sql("ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-30'", "true"),
)
def stage_event_subscription(spark, sf):
    return _subscription_stage(spark, sf, "event", WINDOW)


@query(
    "stage_legacy_subscription",
    subscription_sql(
        "true",
        "o_orderdate >= timestamp '1996-01-01' - interval 5 hour and o_orderdate < timestamp '2000-01-01' - interval 5 hour",
    ),
)
def stage_legacy_subscription(spark, sf):
    return _subscription_stage(spark, sf, "legacy", ("1996-01-01", "2000-01-01"))


def _validations_sql(individuals: str = "") -> str:
    """The checks over a full load; ``individuals`` leaves rows of the legacy individuals out."""
    legacy = LEGACY_SQL.replace("as updated from customer)", f"as updated from customer {individuals})")
    return f"""{FULL_LINE}, {legacy}, {HISTORY_SQL},
    named as (select * from dev where account_id is not null and individual_id is not null
              qualify row_number() over (partition by account_id order by updated desc, individual_id desc) = 1),
    account_rows as (select account_id from named join ind using (individual_id)
                     union all select distinct account_id from dev where account_id is not null and individual_id is null)
    select 'identity and start are unique' as check_name, count(*) as failures from
      (select identity_id, valid_from_date_hour from hist2 group by all having count(*) > 1)
    union all select 'legacy accounts are unique', count(*) from (select account_id from account_rows group by 1 having count(*) > 1)
    union all select 'legacy accounts are covered', count(*) from dev where subscription_id is not null and account_id is not null
      and account_id not in (select account_id from account_rows)
    union all select 'individuals are unique persons', count(*) from (
      select individual_id from p4 where individual_id is not null group by 1 having count(*) > 1)
    union all select 'every history row has a person', count(*) from hist2 where person_id is null"""


@query("identity_validations", _validations_sql())
def identity_validations(spark, sf):
    """The whole load, then its checks. An account with and without individuals has two rows."""
    devices, individuals, known = _legacy_tables(spark, sf)
    person, history = identity.identity_load(stages(spark, sf), known, devices, individuals)
    return identity.validation_report(materialize(history, "history"), person, devices)


@query("identity_validations_gaps", _validations_sql("where c_nationkey % 2 = 0"))
def identity_validations_gaps(spark, sf):
    """The checks where half of the legacy individuals are missing: their accounts are not covered."""
    devices, individuals, known = _legacy_tables(spark, sf)
    some = F.substring("household_id", 2, 9).cast("int") % 2 == 0
    individuals, known = individuals.where(some), known.where(some)
    person, history = identity.identity_load(stages(spark, sf), known, devices, individuals)
    return identity.validation_report(materialize(history, "history"), person, devices)
