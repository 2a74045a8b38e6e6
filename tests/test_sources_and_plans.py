"""Watermarks, files, whole jobs and the streaming entry point."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_scd2 import SPEC, T0, event, flat, project
from test_scd2 import SCHEMA as EVENT_SCHEMA

from dataclasses import replace

from histkit.config import JobSpec
from histkit.operators import merge as mg
from histkit.operators import scd2
from histkit.plans import agent, history_job, pull, trial_fact
from histkit.sources import files
from histkit.sources.buckets import BucketTable
from histkit.sources import watermark as wm
from histkit.streaming.incremental import load_new_files


def test_watermark_life(spark, tmp_path):
    path = str(tmp_path / "wm")
    assert wm.read_watermark(spark, path) is None and wm.read_watermark(spark, None) is None
    with pytest.raises(LookupError):
        wm.read_watermark(spark, path, required=True)
    with pytest.raises(ValueError):
        wm.write_watermark(spark, path, None, None)
    wm.write_watermark(spark, path, None, T0)
    assert wm.read_watermark(spark, path) == T0
    df = spark.createDataFrame([(T0 + timedelta(hours=3),)], "ts timestamp_ntz")
    assert wm.advance_watermark(df, "ts", path) == T0 + timedelta(hours=3)
    assert wm.advance_watermark(df.where("false"), "ts", path) is None
    assert wm.read_watermark(spark, path) == T0 + timedelta(hours=3)
    assert wm.newer_than(df, "ts", T0 + timedelta(hours=3)).count() == 0


def test_hour_paths_and_partition_pruning(spark, tmp_path):
    assert files.hour_path("/x/", "2024-03-05T07:09:00") == "/x/2024-03-05/07/"
    df = spark.sql("select id, timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,cast(id as int)) as ts from range(72)")
    path = str(tmp_path / "hours")
    files.write_hour_partitions(df, path, "ts")
    from histkit.operators.events import events_since_hour

    back = events_since_hour(files.read_hour_partitions(spark, path), "2024-01-02 05:30:00")
    assert back.count() == 72 - 29
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_scratch_dir_is_in_the_shared_folder(spark):
    assert files.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_tables_by_name(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    files.write_target(spark.range(2).withColumn("x", F.lit(1)), a)
    files.write_target(spark.range(3), b)
    files.write_target(spark.range(3), b, "append")
    df = files.read_tables(spark, {"t": [a, b]}, "t", lambda d: d.where("id > 0"))
    assert df.count() == 5 and df.where("x is null").count() == 4


def test_history_job_loads_and_reruns(spark, tmp_path):
    base = str(tmp_path / "target")
    spec = JobSpec(SPEC.read, replace(SPEC.write, to_table=base))
    one = spark.createDataFrame([event(1, 0, "Created", "a"), event(2, 0, "Created", "a")], EVENT_SCHEMA)
    two = spark.createDataFrame([event(1, 5, "Updated", "b"), event(2, 6, "Deleted", "a")], EVENT_SCHEMA)
    history_job.run_history_job(spark, spec, one, 1, "2024-03-01", project, first_load=True)
    for _ in range(2):
        history_job.run_history_job(spark, spec, two, 2, "2024-03-02", project)
    got = flat(files.read_snapshot(spark, base))
    assert [(r[0], r[1], r[4], r[5]) for r in got] == [
        (1, "a", False, False),
        (1, "b", True, False),
        (2, "a", False, False),
        (2, "a", False, True),
    ]


def test_stream_of_files_equals_batches(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    spec = JobSpec(SPEC.read, replace(SPEC.write, to_table=out))
    events = [event(i % 3, i, ("Created", "Updated", "Deleted")[i % 3 if i > 20 else 1], "ab"[i // 4 % 2], i) for i in range(40)]

    def load(batch, batch_id):
        history_job.run_history_job(spark, spec, batch, batch_id + 1, "2024-03-01", project, first_load=batch_id == 0)

    schema = spark.createDataFrame([], EVENT_SCHEMA).schema
    for part in (events[:15], events[15:]):
        spark.createDataFrame(part, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        load_new_files(spark, src, schema, load, check).awaitTermination()
    full = scd2.scd2_pipeline(spark.createDataFrame(events, EVENT_SCHEMA), None, spec, "2024-03-01", project)
    assert flat(files.read_snapshot(spark, out)) == flat(full)


def test_delta_loads_leave_closed_files_alone(spark, tmp_path):
    base = str(tmp_path / "target")
    spec = JobSpec(SPEC.read, replace(SPEC.write, to_table=base))

    def load(rows, version, **more):
        history_job.run_history_job(spark, spec, spark.createDataFrame(rows, EVENT_SCHEMA), version, "2024-03-01", project, **more)

    first = [event(i, h, "Updated", f"{h}") for i in range(5) for h in range(3)]
    second, third = [event(1, 9, "Updated", "x"), event(99, -10**6, "Created", "old")], [event(2, 9, "Deleted", "2")]
    load(first, 1, first_load=True)
    files_then = {p: p.stat().st_mtime_ns for p in (tmp_path / "target").rglob("part=*/**/*.parquet")}
    early = files.read_snapshot(spark, base)
    n = early.count()
    load(second, 2)
    load(third, 3)
    load(third, 3)  # a repeated run
    assert all(p.stat().st_mtime_ns == t for p, t in files_then.items())
    assert early.count() == n  # whoever read the first version still can
    full = scd2.scd2_pipeline(spark.createDataFrame(first + second + third, EVENT_SCHEMA), None, spec, "2024-03-01", project)
    assert flat(files.read_snapshot(spark, base)) == flat(full)
    assert files.read_open(spark, base).count() == full.where("is_current").count()
    assert files.read_snapshot(spark, base, before=3).count() < full.count()


def test_many_parts_become_one_and_unused_parts_go(spark, tmp_path):
    base = str(tmp_path / "target")
    spec = JobSpec(SPEC.read, replace(SPEC.write, to_table=base, most_parts=3))
    batches = [[event(i, 10 * n + i, "Updated", f"{n}") for i in range(4)] for n in range(5)]
    for n, rows in enumerate(batches):
        history_job.run_history_job(spark, spec, spark.createDataFrame(rows, EVENT_SCHEMA), n + 1, "2024-03-01", project, first_load=n == 0)
        assert len(files._manifest(spark, base).parts) <= 3
    whole = scd2.scd2_pipeline(spark.createDataFrame(sum(batches, []), EVENT_SCHEMA), None, spec, "2024-03-01", project)
    assert flat(files.read_snapshot(spark, base)) == flat(whole)
    parts = {p.name for p in (tmp_path / "target").glob("part=*")}
    gone = files.remove_unused_parts(spark, base, 1)
    left = {p.name for p in (tmp_path / "target").glob("part=*")}
    assert gone and left == parts - {f"part={g}" for g in gone}
    assert flat(files.read_snapshot(spark, base)) == flat(whole) and files.remove_unused_parts(spark, base, 1) == []
    with pytest.raises(ValueError):
        files.remove_unused_parts(spark, base, 0)


def test_bucket_pull_writes_only_changes(spark, tmp_path):
    base, mark = str(tmp_path / "export"), str(tmp_path / "mark")
    target = BucketTable(str(tmp_path / "t"), ("k",), 16)
    target.write(spark.createDataFrame([(i, "old") for i in range(60)], "k int, v string"))
    run = "2024-03-01 04:00:00"
    rows = [(1, "old", T0, 1), (2, "new", T0, 2), (2, "older", T0, 1), (99, "c", T0 + timedelta(hours=1), 1)]
    spark.createDataFrame(rows, "k int, v string, ts timestamp_ntz, n int").write.parquet(files.hour_path(base, run))
    stamps = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    before = stamps()
    pull.run_bucket_pull(spark, base, target, run, "ts", mark, {"n": False})
    after = stamps()
    changed = set(target.touched(spark.createDataFrame([(2,), (99,)], "k int")))
    assert {int(p.parent.name.split("=")[1]) for p in before if p not in after} == changed
    assert {tuple(r) for r in target.read(spark).collect()} == {(i, "old") for i in range(60) if i != 2} | {(2, "new"), (99, "c")}
    assert wm.read_watermark(spark, mark) == T0 + timedelta(hours=1)
    pull.run_bucket_pull(spark, base, target, run, "ts", mark, {"n": False})
    assert stamps() == after  # nothing left to write


def test_a_broken_write_is_invisible(spark, tmp_path):
    base = str(tmp_path / "t")
    with pytest.raises(LookupError):
        files.read_snapshot(spark, base)
    files.write_snapshot(spark.range(3), base, 1)
    spark.range(9).withColumn("_open", F.lit(True)).write.partitionBy("_open").parquet(f"{base}/part=v2-unfinished")
    assert files.read_snapshot(spark, base).count() == 3
    files.write_snapshot(spark.range(0), base, 2)
    assert files.read_snapshot(spark, base).count() == 0 and files.read_snapshot(spark, base, before=2).count() == 3


def test_table_targets(spark, tmp_path):
    spark.sql("drop table if exists histkit_target")
    files.write_target(spark.range(3).select("id", F.lit("a").alias("v")), "histkit_target")
    files.write_target(spark.range(2).select(F.lit("b").alias("v"), F.col("id")), "histkit_target", "append")
    assert spark.table("histkit_target").groupBy("v").count().orderBy("v").collect() == [("a", 3), ("b", 2)]
    spark.sql("drop table histkit_target")


def test_agent_extract_load_and_sync(spark):
    cols = {c for c, _ in agent.AGENT_COLUMNS.values()} | {"Agn_Supr_Rec_Key"}
    def make(i, sup, name, at):
        row = dict.fromkeys(cols)
        row |= {"Agn_Rec_Key": i, "CSR_ID": str(i), "Agn_Supr_CSR_ID": str(sup), "Agn_Supr_Rec_Key": sup, "Agn_Fst_NM": name, "updt_ts": at}
        return row
    types = {"Agn_Rec_Key": "int", "Agn_Supr_Rec_Key": "int", "updt_ts": "timestamp_ntz"}
    types |= {c: "date" for c, missing in agent.AGENT_COLUMNS.values() if missing == agent.OPEN_DATE} | {"Agn_Role_End_Dt": "date"}
    schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in sorted(cols))
    day = datetime(9999, 12, 31).date()
    rows = [make(1, 9, "boss", T0), make(2, 1, None, T0 + timedelta(days=1)), make(3, 1, "c", T0 + timedelta(days=2))]
    rows[2]["Agn_Role_End_Dt"] = day
    source = spark.createDataFrame([tuple(r[c] for c in sorted(cols)) for r in rows], schema)
    stage = agent.extract_agents(source, T0, "2024-03-01")
    got = {r.agent_key_id: r for r in stage.collect()}
    assert set(got) == {2, 3} and got[2].agent_first_nm == "Not Defined" and got[2].suprvsr_first_nm == "boss"
    assert str(got[2].lob_tenure_effective_date) == "9999-12-31" and got[2].suprvsr_lob_cd == "Not Defined"
    loaded = mg.merged_rows(agent.load_agents(stage, stage))
    assert loaded.count() == 2
    copy = spark.createDataFrame([(7, "x", "y", day)], "agent_key_id int, agent_id string, csr_id string, rec_exp_ts date")
    assert [r.agent_key_id for r in mg.merged_rows(agent.sync_agents(copy, loaded)).collect()] == [3]


def test_pull_of_an_hourly_export(spark, tmp_path):
    base, target, mark = (str(tmp_path / n) for n in ("export", "target", "mark"))
    run = datetime(2024, 3, 1, 4)
    files.write_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"), target, 1)
    rows = [(1, "a", T0, 1), (2, "new", T0, 2), (2, "old", T0, 1), (3, "c", T0 + timedelta(hours=1), 1)]
    spark.createDataFrame(rows, "k int, v string, ts timestamp_ntz, n int").write.parquet(files.hour_path(base, run))
    for _ in range(2):
        pull.run_pull(spark, base, target, ["k"], run, 2, "ts", mark, {"n": False})
    assert sorted(map(tuple, files.read_snapshot(spark, target).collect())) == [(1, "a"), (2, "new"), (3, "c")]
    assert wm.read_watermark(spark, mark) == T0 + timedelta(hours=1)


def test_trial_fact_load(spark):
    fields = trial_fact.FACT_FIELDS
    assert len(fields) > 100
    stage_cols = sorted({f.source for f in fields.values() if not f.source.startswith("_")} | {"dvc_id", "dvc_id_actl", "opp_in"})
    base = dict.fromkeys(stage_cols)
    base |= {"trial_feat_key": " 5 ", "trial_id": "10", "feat_id": "7", "rec_eff_ts": "2024-01-10", "rec_exp_ts": "2999-12-31"}
    base |= {"srvc_id": "1", "srvc_id_actl": "2", "dvc_id": "ABCDEFGH", "dvc_id_actl": "log", "acct_rec_key": "3", "trial_ofr_id": "x"}
    stage = spark.createDataFrame([tuple(base[c] for c in stage_cols)], ", ".join(f"{c} string" for c in stage_cols))
    day = "cast(%s as date)"
    service = spark.createDataFrame(
        [("1", "ABCDEFGH", "11", "s1", "2024-01-01", "2024-01-31"), ("1", "ABCDEFGH", "12", "s2", "2024-02-01", "2999-12-31"), ("2", "log", "13", "s3", "2024-01-10", "2999-12-31")],
        "srvc_id string, device_id string, srvc_key_id string, sms_sbscrptn_id string, e string, x string",
    ).selectExpr("*", day % "e" + " rec_eff_ts", day % "x" + " rec_exp_ts")
    account = spark.createDataFrame([("3", "parent")], "acct_key_id string, prnt_acct_nbr string")
    nobody = spark.createDataFrame([], "agent_key_id string, csr_id string")
    offer = spark.createDataFrame([("x", "77", "p", "2999-12-31")], "ofr_id string, ofr_key_id string, ofr_pkg_id string, rec_exp_ts string")
    reason = spark.createDataFrame([], "oprtnty_falloff_rsn_nm string, oprtnty_falloff_rsn_cd string")
    rows = trial_fact.fact_rows(trial_fact.resolve_dimensions(stage, account, service, nobody, offer, reason), "2024-03-01")
    r = rows.collect()[0]
    assert (r.trial_ftre_key_id, r.trial_id, r.srvc_key_id, r.actl_srvc_key_id, r.sbscrptn_id) == (5, 10, 11, 13, "s3")
    assert (r.device_id, r.login_id, r.prnt_acct_nbr, r.trial_ofr_key_id, r.trial_ofr_id) == ("ABCDEFGH", "log", "parent", 77, -2)
    assert (r.trial_csr_id, r.party_key_id, str(r.conv_dt)) == ("N/A", -2, "1970-01-01")
    older = rows.withColumns({"trial_ftre_key_id": F.lit(4).cast("bigint"), "rec_eff_ts": F.lit("2023-01-01").cast("date")})
    out = mg.merged_rows(trial_fact.load_fact(older, rows))
    assert sorted((x.trial_ftre_key_id, str(x.rec_exp_ts), x.is_latest_rec_ind) for x in out.collect()) == [
        (4, "2024-01-09", "N"),
        (5, "2999-12-31", "Y"),
    ]
