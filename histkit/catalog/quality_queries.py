"""Data-quality checks, profile counts, watermarks, and round trips through files."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from histkit.catalog.history_queries import AS_OF, HOURLY_SQL, flat_history, full_sql, job, project_user
from histkit.catalog.event_queries import envelope_type
from histkit.catalog.registry import ntz, query, table
from histkit.operators import events as ev
from histkit.operators import quality as dq
from histkit.operators import scd2
from histkit.operators.quality import QualityError, require_rows
from histkit.plans.history_job import run_history_job
from histkit.plans.pull import run_bucket_pull, run_pull
from histkit.sources import files, watermark
from histkit.sources.buckets import BucketTable
from histkit.streaming.incremental import load_new_files


@query(
    "dup_keys",
    "select o_custkey, o_orderdate, count(*) as row_count from orders group by all having count(*) > 1",
)
def dup_keys(spark, sf):
    return dq.duplicate_keys(table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@query(
    "dup_keys_top",
    """select user_id, event_type, count(*) as row_count from events group by all having count(*) > 1
       order by row_count desc, user_id, event_type limit 100""",
)
def dup_keys_top(spark, sf):
    return dq.top_duplicates(table(spark, sf, "events"), ["user_id", "event_type"], 100)


@query(
    "coverage_gap",
    """select o_orderkey, o_custkey from orders left join (select * from customer where c_acctbal > 1000) c
       on c_custkey = o_custkey where c_custkey is null and o_custkey is not null""",
)
def coverage_gap(spark, sf):
    rich = table(spark, sf, "customer").where("c_acctbal > 1000")
    return dq.coverage_gap(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), rich, {"o_custkey": "c_custkey"})


@query(
    "update_histogram",
    """select case when n <= 5 then '<=5' when n <= 12 then '6-12' else '>12' end as segment, count(*) as row_count
       from (select o_custkey, count(*) as n from orders group by 1 having count(*) > 1) group by 1""",
)
def update_histogram(spark, sf):
    return dq.count_histogram(table(spark, sf, "orders"), "o_custkey", (5, 12))


@query("category_counts", "select event_type, count(*) as row_count from events group by 1")
def category_counts(spark, sf):
    return dq.category_counts(table(spark, sf, "events"), "event_type")


@query(
    "load_bounds",
    "select min(o_orderdate) as first_at, max(o_orderdate) as last_at, count(*) as row_count from orders",
)
def load_bounds(spark, sf):
    return table(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"), F.count(F.lit(1)).alias("row_count")
    )


@query("distinct_accounts", "select distinct o_custkey from orders where o_orderstatus <> 'F'")
def distinct_accounts(spark, sf):
    return table(spark, sf, "orders").where("o_orderstatus <> 'F'").select("o_custkey").distinct()


@query(
    "history_sorted",
    "select user_id, ts, event_id from events order by user_id, ts, event_id",
)
def history_sorted(spark, sf):
    return table(spark, sf, "events").select("user_id", "ts", "event_id").orderBy("user_id", "ts", "event_id")


@query(
    "current_rows",
    """select c_custkey, 'flag' as how from customer where c_acctbal > 0
       union all select c_custkey, 'latest' from customer where c_nationkey < 12
       union all select o_orderkey, 'expiry' from orders where o_orderstatus = 'O'""",
)
def current_rows(spark, sf):
    """Open versions, found in each of the three ways tables mark them."""
    customer = table(spark, sf, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") > 0).alias("is_current"),
        F.when(F.col("c_nationkey") < 12, "Y").otherwise("N").alias("latest"),
    )
    open_end = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("c_custkey"),
        F.when(F.col("o_orderstatus") == "O", open_end).otherwise(F.col("o_orderdate")).alias("exp"),
    )
    found = {
        "flag": ev.current_rows(customer),
        "latest": ev.current_rows(customer, latest="latest"),
        "expiry": ev.current_rows(orders, expiry="exp"),
    }
    return ev.union_all([df.select("c_custkey", F.lit(how).alias("how")) for how, df in found.items()])


@query("loaded_watermark", "select max(o_orderdate) as processTimestamp from orders")
def loaded_watermark(spark, sf):
    return watermark.loaded_watermark(table(spark, sf, "orders"), "o_orderdate")


@query(
    "low_watermark",
    """select least((select date_trunc('hour', max(ts)) from events),
                    (select date_trunc('hour', max(o_orderdate)) from orders)) as low_watermark""",
)
def low_watermark(spark, sf):
    def parts(name, ts):
        return table(spark, sf, name).select(F.to_date(ts).alias("date"), F.date_format(ts, "HH").alias("hour"))

    return ntz(watermark.low_watermark([parts("events", "ts"), parts("orders", "o_orderdate")]))


@query(
    "process_window",
    """
    select cast(cast(o_orderdate as date) as varchar) as from_date,
           coalesce(case when o_orderstatus = 'F' then cast(cast(o_orderdate + interval 3 day as date) as varchar) end,
                    cast(cast(timestamp '2002-01-01' + c_nationkey * interval 1 day as date) as varchar)) as to_date
    from orders join customer on c_custkey = o_custkey
    where o_custkey = (select n_nationkey from nation where n_name = 'NATION_7') and o_orderstatus in ('F', 'P')
    """,
)
def process_window(spark, sf):
    status = F.col("o_orderstatus")
    control = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("subject_area_id"),
        F.col("o_orderdate").alias("start_exec_ts"),
        F.when(status == "F", F.col("o_orderdate") + F.expr("INTERVAL '3' DAY")).alias("end_exec_ts"),
        F.when(status.isin("F", "P"), "In Progress").otherwise("Done").alias("process_status_cd"),
    )
    audit = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("subject_area_id"),
        (F.lit("2002-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("c_nationkey"))).alias("batch_start_ts"),
    )
    config = table(spark, sf, "nation").select(
        F.lit("Sales").alias("dept_nm"),
        F.lit("Trial").alias("division_nm"),
        F.lower("n_name").alias("subject_area_nm"),
        F.col("n_nationkey").alias("subject_area_id"),
    )
    return watermark.process_window(control, audit, config, "sales", "trial", "NATION_7")


@query(
    "csv_roundtrip",
    """select o_orderkey, o_orderdate, cast(o_orderdate as date) as order_day, nullif(o_orderpriority, '1-URGENT') as priority,
              o_orderstatus || '|"x' as note, o_totalprice from orders""",
)
def csv_roundtrip(spark, sf):
    """Unload to delimited text (with delimiters and quotes inside values) and load it again."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.to_date("o_orderdate").alias("order_day"),
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("priority"),
        F.concat(F.col("o_orderstatus"), F.lit('|"x')).alias("note"),
        "o_totalprice",
    )
    path = files.scratch_dir(spark, "unload")
    files.write_delimited(rows, path)
    return files.read_delimited(spark, path, rows.schema)


@query(
    "hour_partitions",
    """select event_id, user_id, ts, cast(ts as date) as date, strftime(ts, '%H') as hour from events
       where date_trunc('hour', ts) >= timestamp '2024-01-20 09:00:00'""",
)
def hour_partitions(spark, sf):
    """Write events by date and hour, then read from a watermark's hour on."""
    df = table(spark, sf, "events").select("event_id", "user_id", "ts")
    path = files.scratch_dir(spark, "hours")
    files.write_hour_partitions(df, path, "ts")
    return ev.events_since_hour(files.read_hour_partitions(spark, path), "2024-01-20 09:30:00")


@query(
    "snapshot_versions",
    "select o_orderkey, o_totalprice from orders where o_orderstatus <> 'F'",
)
def snapshot_versions(spark, sf):
    """The newest written version of a table is the one read."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = files.scratch_dir(spark, "snapshot")
    files.write_snapshot(df, path, 1)
    newest = files.read_snapshot(spark, path).where("o_orderstatus <> 'F'")
    files.write_snapshot(newest, path, 2)
    return files.read_snapshot(spark, path).drop("o_orderstatus")


@query("scd2_streamed", full_sql(HOURLY_SQL))
def scd2_streamed(spark, sf):
    """The history job over event files found by the streaming file source: what arrived since the last run is a batch."""
    source, out, checkpoint = (files.scratch_dir(spark, n) for n in ("event-files", "history", "stream"))
    log, at = table(spark, sf, "events"), F.col("ts")
    cuts = [F.lit(c).cast("timestamp_ntz") for c in ("2024-01-11 05:00:00", "2024-01-21 05:00:00")]
    spec = replace(job(), write=replace(job().write, to_table=out))

    def load(batch, batch_id):
        batch = batch.withColumn("envelope_type", envelope_type())
        run_history_job(spark, spec, batch, batch_id + 1, AS_OF, project_user, first_load=batch_id == 0)

    # Rows without a time arrive first; each arrival is as many files as the table has partitions.
    for part in (at.isNull() | (at < cuts[0]), (at >= cuts[0]) & (at < cuts[1]), at >= cuts[1]):
        log.where(part).write.mode("append").parquet(source)
        load_new_files(spark, source, log.schema, load, checkpoint).awaitTermination()
    return flat_history(files.read_snapshot(spark, out))


@query(
    "pull_export",
    """
    with t as (select c_custkey as k, c_name as v from customer where c_custkey % 3 = 0),
         s as (select o_custkey as k, max_by(o_orderpriority, (o_orderdate, o_orderkey)) as v from orders group by 1)
    select coalesce(t.k, s.k) as k, coalesce(s.v, t.v) as v from t full join s using (k)
    """,
)
def pull_export(spark, sf):
    """An hourly export with several rows per key, pulled into a versioned target."""
    base, target, mark = (files.scratch_dir(spark, n) for n in ("export", "pulled", "mark"))
    kept = table(spark, sf, "customer").where("c_custkey % 3 = 0")
    files.write_snapshot(kept.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v")), target, 1)
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v"), "o_orderdate", "o_orderkey")
    run = "2024-03-01 04:00:00"
    rows.write.parquet(files.hour_path(base, run))
    run_pull(spark, base, target, ["k"], run, 2, "o_orderdate", mark, {"o_orderdate": False, "o_orderkey": False})
    return files.read_snapshot(spark, target)


@query(
    "watermark_cycle",
    """with m as (select max(o_orderdate) as w from orders where o_orderdate < timestamp '1998-01-01')
       select o_orderkey, o_orderdate from orders, m where o_orderdate > w""",
)
def watermark_cycle(spark, sf):
    """A load stores how far it came; the next one reads what is newer."""
    mark = files.scratch_dir(spark, "mark")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    first = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    watermark.advance_watermark(first, "o_orderdate", mark)
    return watermark.newer_than(orders, "o_orderdate", watermark.read_watermark(spark, mark, required=True))


@query(
    "pull_export_hours",
    """
    with t as (select c_custkey as k, c_name as v from customer where c_custkey % 3 = 0),
         s as (select o_custkey as k, max_by(o_orderpriority, (o_orderkey % 3, o_orderdate, o_orderkey)) as v from orders group by 1)
    select coalesce(t.k, s.k) as k, coalesce(s.v, t.v) as v from t full join s using (k)
    """,
)
def pull_export_hours(spark, sf):
    """Three hourly exports pulled into a bucketed target, each writing the buckets that change."""
    base, path, mark = (files.scratch_dir(spark, n) for n in ("export", "pulled", "mark"))
    target = BucketTable(path, ("k",), 8)
    kept = table(spark, sf, "customer").where("c_custkey % 3 = 0")
    target.write(kept.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v")))
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v"), "o_orderdate", "o_orderkey")
    for hour in range(3):
        run = f"2024-03-01 0{hour}:00:00"
        rows.where(F.col("o_orderkey") % 3 == hour).write.parquet(files.hour_path(base, run))
        run_bucket_pull(spark, base, target, run, "o_orderdate", mark, {"o_orderdate": False, "o_orderkey": False})
    return target.read(spark)


@query(
    "read_many_tables",
    """select event_id, user_id, null::double as value, 'a' as origin from events where event_type = 'view'
       union all select event_id, user_id, value, 'b' from events where event_type = 'click'""",
)
def read_many_tables(spark, sf):
    """The tables listed under a logical name, read, transformed and united by column name."""
    log = table(spark, sf, "events")
    parts = [files.scratch_dir(spark, n) for n in ("views", "clicks")]
    log.where("event_type = 'view'").select("event_id", "user_id", F.lit("a").alias("origin")).write.parquet(parts[0])
    log.where("event_type = 'click'").select("user_id", "event_id", "value", "ts", F.lit("b").alias("origin")).write.parquet(parts[1])
    return files.read_tables(spark, {"activity": parts, "other": []}, "activity", lambda df: df.drop("ts"))


@query(
    "target_overwrite_append",
    """select o_orderkey, o_totalprice, o_orderstatus from orders where o_orderstatus = 'F'
       union all select o_orderkey, o_totalprice, 'late' from orders where o_orderstatus = 'O'""",
)
def target_overwrite_append(spark, sf):
    """A target that is replaced whole, then added to; an empty input is refused before anything is written."""
    path = files.scratch_dir(spark, "target")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.write_target(orders, path)
    files.write_target(require_rows(orders.where("o_orderstatus = 'F'")), path)
    late = orders.where("o_orderstatus = 'O'").withColumn("o_orderstatus", F.lit("late"))
    files.write_target(require_rows(late), path, "append")
    try:
        files.write_target(require_rows(orders.where("o_orderstatus = 'none'")), path)
    except QualityError:
        return spark.read.parquet(path)
    raise AssertionError("an empty input was written")
