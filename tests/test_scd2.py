"""Edge cases of change detection, validity, deletes and incremental loads."""

import random
from datetime import datetime, timedelta

import pytest

from histkit.config import Interval, JobSpec, ReadSpec, WriteSpec, job_spec
from histkit.functions.hashing import row_hash
from histkit.functions.times import local_time, offset_minutes, utc_of_local
from histkit.operators import events as ev
from histkit.operators import merge as mg
from histkit.operators import scd2

T0 = datetime(2024, 1, 1, 12)
SCHEMA = "id int, envelopeTime timestamp_ntz, envelopeType string, seq int, payload string"
SPEC = JobSpec(
    ReadSpec(
        ("e",),
        ("id",),
        (("envelopeTime", "desc"), ("etl_metadata_struct.is_deleted", "desc"), ("seq", "desc")),
        interval=Interval.HOUR,
    ),
    WriteSpec("t", ("id",), target_order_by=("valid_from_est_timestamp",)),
)


def project(df):
    return df.select(
        "id", "payload", "valid_from_est_timestamp", "valid_to_est_timestamp", "is_current", "etl_metadata_struct"
    )


def event(i, hours, kind, payload, seq=0):
    return (i, T0 + timedelta(hours=hours), f"Thing{kind}", seq, payload)


def build(spark, events, target=None):
    df = spark.createDataFrame(events, SCHEMA)
    return scd2.scd2_pipeline(df, target, SPEC, "2024-03-01", project)


def load(spark, events, target=None):
    rows = build(spark, events, target)
    rows = rows if target is None else mg.merged_rows(mg.merge_scd2_current(target, rows, ["id"]))
    return spark.createDataFrame(rows.collect(), rows.schema)  # a load is stored before the next one


def flat(df):
    return sorted(
        (r.id, r.payload, r.valid_from_est_timestamp, r.valid_to_est_timestamp, r.is_current, r.etl_metadata_struct.is_deleted)
        for r in df.collect()
    )


def test_delete_with_same_payload_is_kept(spark):
    got = flat(build(spark, [event(1, 0, "Created", "a"), event(1, 2, "Deleted", "a")]))
    start, gone = T0 - timedelta(hours=5), T0 - timedelta(hours=3)
    assert got == [(1, "a", start, gone, False, False), (1, "a", gone, gone, False, True)]


def test_recreation_after_delete_is_kept_full_and_incremental(spark):
    events = [event(1, 0, "Created", "a"), event(1, 2, "Deleted", "a"), event(1, 5, "Created", "a")]
    full = flat(build(spark, events))
    assert [r[4] for r in full] == [False, False, True]
    first = load(spark, events[:2])
    assert flat(load(spark, events[2:], first)) == full


def test_unchanged_update_is_dropped_and_local_day_boundary(spark):
    events = [event(1, 0, "Created", "a"), event(1, 3, "Updated", "a"), event(1, 6, "Updated", "b")]
    assert [r[1] for r in flat(build(spark, events))] == ["a", "b"]
    df = spark.createDataFrame([(1, datetime(2024, 1, 2, 3))], "id int, envelopeTime timestamp_ntz")
    assert ev.events_on(df, "2024-01-01").count() == 1 and ev.events_on(df, "2024-01-02").count() == 0


def test_two_verbs_at_one_time(spark):
    both = [event(1, 0, "Updated", "a"), event(1, 0, "Deleted", "a")]
    assert flat(build(spark, both))[0][5] is True
    df = spark.createDataFrame(both, SCHEMA).withColumn("gone", ev.delete_flag("envelopeType"))
    keep = ev.latest_per_interval(df, "envelopeTime", ["id"], [("envelopeTime", "desc"), ("gone", "asc")], Interval.EVENT)
    assert keep.collect()[0].gone is False


def test_late_event_is_dropped(spark):
    first = load(spark, [event(1, 10, "Created", "a")])
    assert flat(load(spark, [event(1, 2, "Updated", "late")], first)) == flat(first)


def test_replay_after_tombstone_changes_nothing(spark):
    first = load(spark, [event(1, 0, "Created", "a")])
    batch = [event(1, 2, "Updated", "b"), event(1, 4, "Deleted", "b")]
    once = load(spark, batch, first)
    assert flat(load(spark, batch, once)) == flat(once)


def test_closed_key_that_returns_counts_as_changed(spark):
    schema = "id int, payload string, is_current boolean"
    target = spark.createDataFrame([(1, "a", False), (2, "a", True), (3, "a", True)], schema)
    src = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "x")], "id int, payload string")
    got = scd2.ignore_unchanged_vs_target(src, target, ["id"])
    assert sorted(r.id for r in got.collect()) == [1, 3, 4]


@pytest.mark.parametrize("seed", range(3))
def test_random_loads_equal_rebuild_and_keep_their_invariants(spark, seed):
    rng = random.Random(seed)
    events = [
        event(rng.randrange(6), h, rng.choice(["Created", "Updated", "Updated", "Deleted"]), rng.choice("ab"), i)
        for i, h in enumerate(sorted(rng.randrange(200) for _ in range(120)))
    ]
    full = flat(build(spark, events))
    cuts = [60, 130]
    parts = [[e for e in events if lo <= (e[1] - T0).total_seconds() / 3600 < hi] for lo, hi in zip([0, *cuts], [*cuts, 999])]
    target = None
    for part in parts:
        target = load(spark, part, target)
    assert flat(target) == full
    by_key = {}
    for r in full:
        by_key.setdefault(r[0], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r[2])
        assert sum(r[4] for r in versions) <= 1
        for a, b in zip(versions, versions[1:]):
            assert a[3] == (a[2] if a[5] else b[2])
            assert a[5] or b[5] or a[1] != b[1]


def test_every_event_with_one_dominant_key(spark):
    events = [event(1, i / 7, "Updated", "ab"[(i // 3) % 2], i) for i in range(300)] + [event(2, 1, "Created", "a", 999)]
    spec = JobSpec(
        ReadSpec(("e",), ("id",), SPEC.read.order_by, interval=Interval.EVENT), SPEC.write
    )
    df = spark.createDataFrame(events, SCHEMA)
    got = flat(scd2.scd2_pipeline(df, None, spec, "2024-03-01", project, hot_rows=50))
    assert got == flat(scd2.scd2_pipeline(df, None, spec, "2024-03-01", project))
    assert len(got) == 101 and sum(r[4] for r in got) == 2


def test_hash_rules(spark):
    df = spark.createDataFrame(
        [(1, "a", None, "b", {"x": 1, "y": 2}, [1, 2]), (2, "ab", None, None, {"y": 2, "x": 1}, [2, 1])],
        "id int, p string, q string, r string, m map<string,int>, arr array<int>",
    )

    def hashes(cols, compat=False):
        return [r.hash_md5 for r in row_hash(df.select("id", *cols), ["id"], compat=compat).orderBy("id").collect()]

    assert len(set(hashes(["p", "q", "r"]))) == 2
    assert len(set(hashes(["p", "q", "r"], compat=True))) == 1
    assert len(set(hashes(["m"]))) == 1 and len(set(hashes(["m"], compat=True))) == 1
    assert len(set(hashes(["arr"]))) == 2
    assert hashes(["p", "m"]) == hashes(["m", "p"])


def test_hash_sees_microseconds_and_nested_maps(spark):
    rows = [(datetime(2024, 1, 1, 0, 0, 0, 1), [{"b": "1", "a": "2"}]), (datetime(2024, 1, 1, 0, 0, 0, 2), [{"a": "2", "b": "1"}])]
    df = spark.createDataFrame(rows, "at timestamp_ntz, maps array<map<string,string>>")
    assert row_hash(df).select("hash_md5").distinct().count() == 2
    assert row_hash(df.select("maps")).select("hash_md5").distinct().count() == 1


def test_zones(spark):
    assert offset_minutes("UTC-5") == offset_minutes("GMT-5") == -300 and offset_minutes("America/New_York") is None
    assert utc_of_local("2024-07-01", "America/New_York") == datetime(2024, 7, 1, 4)
    df = spark.createDataFrame([(datetime(2024, 7, 1, 2),)], "ts timestamp_ntz")
    row = df.select(local_time("ts").alias("a"), local_time("ts", "America/New_York").cast("timestamp_ntz").alias("b")).first()
    assert row.a == datetime(2024, 6, 30, 21) and row.b == datetime(2024, 6, 30, 22)


def test_text_timestamps_are_parsed(spark):
    df = spark.createDataFrame([("2024-01-01T03:00:00Z", 1), ("2024-01-01 04:30:00", 1)], "at string, id int")
    rows = scd2.source_timestamps(scd2.seed_scd2(df, "at"), "at", "at").orderBy("at").collect()
    assert [str(r.valid_from_est_timestamp) for r in rows] == ["2023-12-31 23:30:00", "2023-12-31 22:00:00"]
    assert rows[0].source_timestamp_struct.create_est_timestamp == rows[0].valid_from_est_timestamp
    assert ev.latest_per_interval(df, "at", ["id"], ["at"], Interval.DAY).count() == 1


def test_date_filters_need_a_date_and_new_york_days(spark):
    df = spark.createDataFrame([(datetime(2024, 7, 1, 4),), (datetime(2024, 7, 1, 3, 59),)], "envelopeTime timestamp")
    with pytest.raises(ValueError):
        ev.events_by_date(df)
    assert ev.events_on(df, "2024-07-01", zone="America/New_York").count() == 1


def test_job_file():
    spec = job_spec(
        {
            "read": {"fromTables": {"v": ["a", "b"]}, "sourcePartitionKey": ["id"], "orderBy": ["ts"], "latestEventIntervalType": "HOUR", "more": 1},
            "write": {"toTable": "t", "targetTableUniqueKey": ["id"], "queryName": "q"},
            "seqBackfillOptions": {"startDate": "2024-01-01", "endDate": "2024-01-31"},
        }
    )
    assert spec.full_reload and spec.read.interval is Interval.HOUR and spec.read.source_keys == ("id",)
    assert "etl_metadata_struct" in spec.write.hash_exclude
    with pytest.raises(ValueError):
        job_spec({"read": {}, "write": {}, "other": {}})


def test_stage_dedups_before_comparing(spark):
    rows = [(1, T0, "a", False), (1, T0 + timedelta(minutes=5), "b", False), (1, T0 + timedelta(hours=1), "b", False)]
    df = spark.createDataFrame(rows, "id int, envelopeTime timestamp_ntz, v string, is_deleted boolean")
    got = scd2.scd_stage(df, "id", ["v"], ["envelopeTime"]).collect()
    assert [(r.v, r.is_current) for r in got] == [("b", True)]


def test_plan_is_declarative(spark):
    df = spark.createDataFrame([event(1, 0, "Created", "a")], SCHEMA)
    plan = scd2.scd2_pipeline(df, None, SPEC, "2024-03-01", project)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan.replace("PythonRDD", "")


def test_consolidate_takes_the_batch_keys_only(spark):
    target = build(spark, [event(i, 0, "Created", "a") for i in range(20)])
    batch = build(spark, [event(3, 5, "Updated", "b"), event(77, -10**6, "Created", "old"), event(4, -5, "Updated", "late")])
    batch = batch.select(*target.columns)
    rows = scd2.consolidate(batch, target, ["id"]).collect()
    assert sorted((r.id, r.payload) for r in rows) == [(3, "a"), (3, "b"), (4, "a"), (77, "old")]
    assert [(r.id, r.payload) for r in scd2.late_events(batch, target, ["id"]).collect()] == [(4, "late")]
    assert scd2.consolidate(batch, target, ["id"], all_current=True).count() == 22
