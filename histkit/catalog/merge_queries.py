"""Merges into type-1, type-2 and warehouse tables, and fact loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from histkit.catalog.event_queries import ENVELOPE_SQL, envelope_type
from histkit.catalog.history_queries import (
    AS_OF,
    HOURLY_SQL,
    crud_events,
    flat_history,
    full_sql,
    job,
    project_user,
    two_loads,
)
from histkit.catalog.registry import ntz, query, table
from histkit.functions.casts import Field, device_for_feature, login_for_feature, safe_cast
from histkit.operators import events as ev
from histkit.operators import digests, facts
from histkit.operators import joins as jn
from histkit.operators import merge as mg
from histkit.operators import scd2
from histkit.operators.windows import next_value
from histkit.sources.files import materialize

CUT = "2024-01-16 00:00:00"
LATEST_USER = f"""select user_id, event_type, value, {ENVELOPE_SQL} as envelope_type from events
                  where {{cond}} qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
BEFORE = LATEST_USER.format(cond=f"ts < timestamp '{CUT}'")
AFTER = LATEST_USER.format(cond=f"ts >= timestamp '{CUT}'")
# Half of the early users form the target, so that the batch also brings new ones.
SCD1_TARGET = f"select * from ({BEFORE}) where event_type in ('click', 'view', 'purchase')"


def _scd1_sides(spark, sf):
    log = table(spark, sf, "events").withColumn("envelope_type", envelope_type())
    before = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")

    def latest(df, as_of):
        df = ev.top_rank(df, ["user_id"], ["ts", "event_id"])
        df = scd2.audit_struct(df, as_of, delete_pattern="Deleted", type_col="envelope_type")
        return df.select("user_id", "event_type", "value", "envelope_type", "etl_metadata_struct")

    target = latest(log.where(before), "2024-01-16 00:00:00").where(F.col("event_type").isin("click", "view", "purchase"))
    return target, latest(log.where(~before), "2024-02-01 00:00:00")


def _flat_scd1(df):
    m = "etl_metadata_struct"
    return ntz(
        mg.merged_rows(df).select(
            "user_id",
            "event_type",
            "value",
            F.col(f"{m}.etl_create_est_timestamp").alias("created"),
            F.col(f"{m}.etl_update_est_timestamp").alias("updated"),
        )
    )


def _scd1_sql(delete: str, insert: str) -> str:
    old, new = "timestamp '2024-01-15 19:00:00'", "timestamp '2024-01-31 19:00:00'"
    return f"""
    with t as ({SCD1_TARGET}), s as ({AFTER})
    select coalesce(t.user_id, s.user_id) as user_id,
           case when s.user_id is null then t.event_type else s.event_type end as event_type,
           case when s.user_id is null then t.value else s.value end as value,
           case when t.user_id is null then {new} else {old} end as created,
           case when s.user_id is null then {old} else {new} end as updated
    from t full join s using (user_id)
    where (t.user_id is null and ({insert})) or (t.user_id is not null and not ({delete}))"""


IS_DELETE = "coalesce(s.envelope_type like '%Deleted%', false)"


@query("merge_scd1", _scd1_sql(IS_DELETE, f"not {IS_DELETE}"))
def merge_scd1(spark, sf):
    target, source = _scd1_sides(spark, sf)
    return _flat_scd1(mg.merge_scd1(target, source, ["user_id"], "envelope_type"))


@query("merge_scd1_nodelete", _scd1_sql("false", "true"))
def merge_scd1_nodelete(spark, sf):
    target, source = _scd1_sides(spark, sf)
    return _flat_scd1(mg.merge_scd1(target, source, ["user_id"], "envelope_type", deletes=False))


@query("merge_scd2", full_sql(HOURLY_SQL))
def merge_scd2(spark, sf):
    """The general form, which also compares closed target rows."""
    first, delta = two_loads(spark, sf)
    return flat_history(mg.merged_rows(mg.merge_scd2(first, delta, ["user_id"])))


@query("merge_scd2_replay", full_sql(HOURLY_SQL))
def merge_scd2_replay(spark, sf):
    """Loading the same delta a second time changes nothing."""
    first, delta = two_loads(spark, sf)
    once = materialize(mg.merged_rows(mg.merge_scd2(first, delta, ["user_id"])), "target")
    cut = F.lit("2024-01-16 05:00:00").cast("timestamp_ntz")
    again = scd2.scd2_pipeline(
        crud_events(spark, sf).where(F.col("ts") >= cut), once, job(), AS_OF, project_user
    )
    return flat_history(mg.merged_rows(mg.merge_scd2(once, again, ["user_id"])))


@query(
    "merge_metrics",
    f"""
    with t as ({SCD1_TARGET}), s as ({AFTER}), m as (
      select case when s.user_id is null then 'keep'
                  when t.user_id is null then case when {IS_DELETE} then null else 'insert' end
                  when {IS_DELETE} then 'delete' else 'update' end as action
      from t full join s using (user_id))
    select action, count(*) as row_count from m where action is not null group by action
    """,
)
def merge_metrics(spark, sf):
    target, source = _scd1_sides(spark, sf)
    return mg.merge_metrics(mg.merge_scd1(target, source, ["user_id"], "envelope_type"))


def _agents(spark, sf):
    return ev.project(
        table(spark, sf, "customer"), {"agent_key_id": "c_custkey", "agent_nm": "c_name", "nation_key": "c_nationkey"}
    )


PARTY_T = "select c_custkey as agent_key_id, c_name as agent_nm, c_nationkey as nation_key from customer"
PARTY_S = "select s_suppkey * 2 as agent_key_id, s_name as agent_nm, s_nationkey as nation_key from supplier"


def _staged(spark, sf):
    s = table(spark, sf, "supplier")
    return s.select(
        (F.col("s_suppkey") * 2).alias("agent_key_id"),
        F.col("s_name").alias("agent_nm"),
        F.col("s_nationkey").alias("nation_key"),
    )


@query(
    "upsert_delete_insert",
    f"with t as ({PARTY_T}), s as ({PARTY_S}) select * from t where agent_key_id not in (select agent_key_id from s) "
    "union all select * from s",
)
def upsert_delete_insert(spark, sf):
    target = _agents(spark, sf)
    return mg.merged_rows(mg.upsert_replace(target, _staged(spark, sf), ["agent_key_id"]))


@query(
    "upsert_metrics",
    f"""with t as ({PARTY_T}), s as ({PARTY_S}), a as (
          select case when agent_key_id in (select agent_key_id from s) then 'delete' else 'keep' end as action from t
          union all select 'insert' from s)
        select action, count(*) as row_count from a group by action""",
)
def upsert_metrics(spark, sf):
    target = _agents(spark, sf)
    return mg.merge_metrics(mg.upsert_replace(target, _staged(spark, sf), ["agent_key_id"]))


@query(
    "sync_three_way",
    f"""
    with t as (select *, 'kept' as note from ({PARTY_T}) where nation_key < 20), s as ({PARTY_S})
    select s.agent_key_id, s.agent_nm, s.nation_key, t.note from s left join t using (agent_key_id)
    """,
)
def sync_three_way(spark, sf):
    target = _agents(spark, sf).where("nation_key < 20").withColumn("note", F.lit("kept"))
    return mg.merged_rows(mg.sync(target, _staged(spark, sf), ["agent_key_id"]))


@query(
    "sync_by_digest",
    f"""
    with t as (select *, 'kept' as note from ({PARTY_T}) where nation_key < 20), s as ({PARTY_S})
    select s.agent_key_id, s.agent_nm, s.nation_key, t.note from s left join t using (agent_key_id)
    """,
)
def sync_by_digest(spark, sf):
    """The same contents as the sync, with only the buckets joined whose digests differ."""
    target = _agents(spark, sf).where("nation_key < 20").withColumn("note", F.lit("kept"))
    return mg.merged_rows(digests.sync_by_digest(target, _staged(spark, sf), ["agent_key_id"]))


@query(
    "sync_metrics",
    f"""
    with t as (select * from ({PARTY_T}) where nation_key < 20), s as ({PARTY_S}), a as (
      select case when t.agent_key_id is null then 'insert' when s.agent_key_id is null then 'delete'
                  else 'update' end as action
      from t full join s using (agent_key_id))
    select action, count(*) as row_count from a group by action
    """,
)
def sync_metrics(spark, sf):
    target = _agents(spark, sf).where("nation_key < 20")
    return mg.merge_metrics(mg.sync(target, _staged(spark, sf), ["agent_key_id"]))


@query(
    "merge_person_diff",
    """
    with t as (select c_custkey as individual_id, case when c_nationkey >= 5 then c_mktsegment end as segment,
                      c_nationkey as status_key, 'old' as note from customer where c_acctbal >= 0 or c_nationkey < 5),
         s as (select o_custkey as individual_id, c_mktsegment as segment, o_orderkey as status_key
               from orders join customer on c_custkey = o_custkey
               qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
    select coalesce(t.individual_id, s.individual_id) as individual_id,
           case when s.individual_id is null then t.segment else s.segment end as segment,
           case when t.individual_id is null then s.status_key
                when s.individual_id is not null and t.segment is distinct from s.segment then s.status_key
                else t.status_key end as status_key,
           case when t.individual_id is null then null
                when s.individual_id is not null and t.segment is distinct from s.segment then null
                else t.note end as note
    from t full join s using (individual_id)
    """,
)
def merge_person_diff(spark, sf):
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    target = customer.where("c_acctbal >= 0 or c_nationkey < 5").select(
        F.col("c_custkey").alias("individual_id"),
        F.when(F.col("c_nationkey") >= 5, F.col("c_mktsegment")).alias("segment"),
        F.col("c_nationkey").cast("bigint").alias("status_key"),
        F.lit("old").alias("note"),
    )
    latest = ev.top_rank(orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    source = latest.join(customer, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("o_custkey").alias("individual_id"), F.col("c_mktsegment").alias("segment"), F.col("o_orderkey").alias("status_key")
    )
    take = {c: F.col(f"s.{c}") for c in ("segment", "status_key")}
    merged = mg.merge_if_different(
        target,
        source,
        ["individual_id"],
        {"segment": "segment"},
        {**take, "note": F.lit(None)},
        {**take, "individual_id": F.col("s.individual_id")},
    )
    return mg.merged_rows(merged)


@query(
    "new_and_updated_rows",
    f"""with t as ({PARTY_T}), s as (select c_custkey * 2 as agent_key_id, c_name as agent_nm, c_nationkey as nation_key from customer)
        select s.* from s left join t using (agent_key_id)
        where t.agent_key_id is null or s.agent_nm <> t.agent_nm or s.nation_key <> t.nation_key""",
)
def new_and_updated_rows(spark, sf):
    target = _agents(spark, sf)
    source = target.withColumn("agent_key_id", F.col("agent_key_id") * 2)
    return mg.new_and_updated(source, target, ["agent_key_id"])


FACT_CUT = "2000-06-01 00:00:00"
FACT_SQL = f"""
    with f as (select o_orderkey as row_key, o_custkey as trial_id, o_orderpriority as ftre_cd,
                      cast(o_orderdate as date) as rec_eff_ts,
                      coalesce(cast(lead(o_orderdate) over w as date) - 1, date '2999-12-31') as rec_exp_ts,
                      case when lead(o_orderdate) over w is null then 'Y' else 'N' end as is_latest_rec_ind
               from orders where o_orderdate < timestamp '{FACT_CUT}'
               window w as (partition by o_custkey, o_orderpriority order by o_orderdate, o_orderkey)),
         st as (select o_orderkey as row_key, o_custkey as trial_id, o_orderpriority as ftre_cd,
                       cast(o_orderdate as date) as rec_eff_ts from orders
                where o_orderdate >= timestamp '{FACT_CUT}'),
         m as (select trial_id, ftre_cd, min(rec_eff_ts) as start from st group by all)
    select f.row_key, f.trial_id, f.ftre_cd, f.rec_eff_ts,
           case when f.rec_exp_ts = date '2999-12-31' and m.start is not null then cast(m.start - 1 as date)
                else cast(f.rec_exp_ts as date) end as rec_exp_ts,
           case when f.rec_exp_ts = date '2999-12-31' and m.start is not null then 'N' else f.is_latest_rec_ind end as is_latest_rec_ind
    from f left join m using (trial_id, ftre_cd)
    union all select row_key, trial_id, ftre_cd, rec_eff_ts, date '2999-12-31', 'Y' from st"""


def _fact_and_stage(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_key"),
        F.col("o_custkey").alias("trial_id"),
        F.col("o_orderpriority").alias("ftre_cd"),
        F.to_date("o_orderdate").alias("rec_eff_ts"),
    )
    early = F.col("rec_eff_ts") < F.lit("2000-06-01").cast("date")
    # A (trial, feature) pair may hold any number of versions: cut by day and blocks of keys.
    slices = F.struct(F.col("rec_eff_ts"), F.floor(F.col("row_key") / 1_000_000))
    fact = next_value(
        rows.where(early), ["trial_id", "ftre_cd"], ["rec_eff_ts", "row_key"], F.col("rec_eff_ts"), "_next", slices
    )
    fact = fact.select(
        *rows.columns,
        F.coalesce(F.date_sub("_next", 1), F.lit("2999-12-31").cast("date")).alias("rec_exp_ts"),
        F.when(F.col("_next").isNull(), "Y").otherwise("N").alias("is_latest_rec_ind"),
    )
    stage = rows.where(~early).withColumns(
        {"rec_exp_ts": F.lit("2999-12-31").cast("date"), "is_latest_rec_ind": F.lit("Y")}
    )
    return materialize(fact, "fact"), stage


_MATCH = {"trial_id": "trial_id", "ftre_cd": "ftre_cd"}
_ROW = {"row_key": "row_key"}


@query("fact_expire_insert", FACT_SQL)
def fact_expire_insert(spark, sf):
    fact, stage = _fact_and_stage(spark, sf)
    return mg.merged_rows(facts.expire_and_insert(fact, stage, _MATCH, _ROW))


@query("fact_expire_insert_twice", FACT_SQL)
def fact_expire_insert_twice(spark, sf):
    """Loading the same stage again neither closes nor adds rows."""
    fact, stage = _fact_and_stage(spark, sf)
    once = materialize(mg.merged_rows(facts.expire_and_insert(fact, stage, _MATCH, _ROW)), "fact")
    return mg.merged_rows(facts.expire_and_insert(once, stage, _MATCH, _ROW))


@query(
    "fact_star_lookup",
    """
    with l as (select l_orderkey, l_linenumber, l_partkey, case when l_returnflag = 'R' then null else l_suppkey end as supp_key,
                      l_shipdate from lineitem),
         offers as (select p_partkey, p_name, p_brand from part where p_size < 40)
    select l.l_orderkey, l.l_linenumber, l.l_partkey, l.supp_key, l.l_shipdate,
           coalesce(o.p_brand, 'N/A') as offer_brand, coalesce(s.s_nationkey, -2) as nation_key,
           coalesce(n.n_name, 'N/A') as nation_nm, coalesce(p2.p_type, 'N/A') as part_type
    from l left join offers o on o.p_partkey = l.l_partkey
           left join supplier s on s.s_suppkey = l.supp_key
           left join nation n on n.n_nationkey = coalesce(s.s_nationkey, -2)
           left join part p2 on p2.p_partkey = l.l_partkey
    """,
)
def fact_star_lookup(spark, sf):
    fact = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("supp_key"),
        "l_shipdate",
    )
    part = table(spark, sf, "part")
    dims = [
        jn.Lookup(part, {"l_partkey": "p_partkey"}, {"offer_brand": "p_brand"}, F.col("p_size") < 40, defaults={"offer_brand": "N/A"}),
        jn.Lookup(table(spark, sf, "supplier"), {"supp_key": "s_suppkey"}, {"nation_key": "s_nationkey"}, defaults={"nation_key": -2}),
        jn.Lookup(table(spark, sf, "nation"), {"nation_key": "n_nationkey"}, {"nation_nm": "n_name"}, defaults={"nation_nm": "N/A"}),
        jn.Lookup(part, {"l_partkey": "p_partkey"}, {"part_type": "p_type"}, defaults={"part_type": "N/A"}),
    ]
    return jn.star_lookup(fact, dims)


VERSION_SQL = """
    select o_custkey as srvc_id, o_orderkey as srvc_key, o_orderdate as eff,
           o_orderdate + interval 60 day as exp from orders"""


@query(
    "fact_between_join",
    f"""
    with v as ({VERSION_SQL}), f as (select o_orderkey as fact_key, o_custkey as srvc_id, o_orderdate + interval 30 day as at from orders)
    select f.fact_key, f.srvc_id, f.at, v.srvc_key from f left join v
      on v.srvc_id = f.srvc_id and f.at between v.eff and v.exp
    """,
)
def fact_between_join(spark, sf):
    """Versions of a service may overlap here, so every version valid at the time is returned."""
    orders = table(spark, sf, "orders")
    fact = orders.select(
        F.col("o_orderkey").alias("fact_key"),
        F.col("o_custkey").alias("srvc_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL '30' DAY")).alias("at"),
    )
    dim = orders.select(
        F.col("o_custkey").alias("srvc_id"),
        F.col("o_orderkey").alias("srvc_key"),
        F.col("o_orderdate").alias("eff"),
        (F.col("o_orderdate") + F.expr("INTERVAL '60' DAY")).alias("exp"),
    )
    return jn.range_join(fact, dim, {"srvc_id": "srvc_id"}, "at", "eff", "exp", {"srvc_key": "srvc_key"})


LONG_SQL = """
    select o_custkey as srvc_id, o_orderkey as srvc_key, o_orderdate as eff,
           case when o_orderkey % 7 = 0 then timestamp '9999-12-31' else o_orderdate + to_days((o_orderkey % 5 * 400)::integer) end as exp from orders"""


@query(
    "fact_long_versions",
    f"""
    with v as ({LONG_SQL}), f as (select o_orderkey as fact_key, o_custkey as srvc_id, o_orderdate + interval 200 day as at from orders)
    select f.fact_key, f.srvc_id, f.at, v.srvc_key from f left join v
      on v.srvc_id = f.srvc_id and f.at >= v.eff and f.at < v.exp
    """,
)
def fact_long_versions(spark, sf):
    """Versions of a service overlap for years or have no end; the end itself is left out."""
    key, start = F.col("o_orderkey"), F.col("o_orderdate")
    orders = table(spark, sf, "orders")
    fact = orders.select(key.alias("fact_key"), F.col("o_custkey").alias("srvc_id"), (start + F.expr("INTERVAL '200' DAY")).alias("at"))
    end = F.when(key % 7 == 0, F.lit("9999-12-31").cast("timestamp_ntz")).otherwise(start + F.make_dt_interval((key % 5 * 400).cast("int")))
    dim = orders.select(F.col("o_custkey").alias("srvc_id"), key.alias("srvc_key"), start.alias("eff"), end.alias("exp"))
    return jn.range_join(fact, dim, {"srvc_id": "srvc_id"}, "at", "eff", "exp", {"srvc_key": "srvc_key"}, closed=False)


RAW_SQL = """
    select l_orderkey as row_id, l_linenumber as line_id,
           case when l_linenumber = 1 then '' else ' ' || l_partkey || ' ' end as part_txt,
           case when l_returnflag = 'R' then 'x' || l_suppkey else '' || l_suppkey end as supp_txt,
           case when l_linestatus = 'O' then null else ' ' || l_returnflag end as flag_txt,
           case when l_linenumber = 2 then '' when l_linenumber = 3 then null else strftime(l_shipdate, '%Y-%m-%d') end as ship_txt
    from lineitem"""


@query(
    "fact_safe_cast",
    f"""
    select row_id, line_id, coalesce(try_cast(nullif(trim(part_txt), '') as bigint), -2) as part_key,
           coalesce(try_cast(nullif(trim(supp_txt), '') as integer), -2) as supp_key,
           coalesce(trim(flag_txt), 'N/A') as flag,
           coalesce(cast(nullif(trim(ship_txt), '') as date), date '1970-01-01') as ship_date
    from ({RAW_SQL})
    """,
)
def fact_safe_cast(spark, sf):
    line = F.col("l_linenumber")
    raw = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("row_id"),
        line.alias("line_id"),
        F.when(line == 1, "").otherwise(F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" "))).alias("part_txt"),
        F.concat(F.when(F.col("l_returnflag") == "R", "x").otherwise(""), F.col("l_suppkey").cast("string")).alias("supp_txt"),
        F.when(F.col("l_linestatus") != "O", F.concat(F.lit(" "), F.col("l_returnflag"))).alias("flag_txt"),
        F.when(line == 2, "").when(line != 3, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ship_txt"),
    )
    fields = {
        "part_key": Field("part_txt", "bigint"),
        "supp_key": Field("supp_txt", "int"),
        "flag": Field("flag_txt", "string"),
        "ship_date": Field("ship_txt", "date"),
    }
    return safe_cast(raw, fields, keep=["row_id", "line_id"])


DEVICE_SQL = """
    select l_orderkey as row_id, l_linenumber as feat_id, l_suppkey::varchar as srvc_id, (l_partkey % 100)::varchar as srvc_id_actl,
           ' ' || l_orderkey || l_partkey || l_suppkey as dvc_id,
           case when l_returnflag = 'A' then '' else l_returnflag end as dvc_id_actl from lineitem"""


@query(
    "fact_conditional_ids",
    f"""
    select row_id, feat_id,
           case when feat_id = 7 then case when trim(srvc_id) = trim(srvc_id_actl) then 'N/A'
                  else case when len(trim(dvc_id)) in (8, 10, 12) then trim(dvc_id) else 'N/A' end end
                else trim(dvc_id) end as device_id,
           case when feat_id = 7 then coalesce(nullif(trim(dvc_id_actl), ''), 'N/A') else 'N/A' end as login_id
    from ({DEVICE_SQL})
    """,
)
def fact_conditional_ids(spark, sf):
    s = "string"
    raw = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("row_id"),
        F.col("l_linenumber").alias("feat_id"),
        F.col("l_suppkey").cast(s).alias("srvc_id"),
        (F.col("l_partkey") % 100).cast(s).alias("srvc_id_actl"),
        F.concat(F.lit(" "), F.col("l_orderkey").cast(s), F.col("l_partkey").cast(s), F.col("l_suppkey").cast(s)).alias("dvc_id"),
        F.when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_returnflag")).alias("dvc_id_actl"),
    )
    return raw.select(
        "row_id",
        "feat_id",
        device_for_feature("feat_id", "srvc_id", "srvc_id_actl", "dvc_id").alias("device_id"),
        login_for_feature("feat_id", "dvc_id_actl").alias("login_id"),
    )
