"""Interval splices, bucket tables, components, and loads that arrive in parts."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from histkit.functions.times import OPEN_END
from histkit.operators import resolve as rs
from histkit.operators.components import components, shared_value_links
from histkit.operators.timeline import splice
from histkit.plans.identity_delta import person_versions
from histkit.sources import files, watermark
from histkit.sources.buckets import BUCKET, BucketTable, newest_load
from histkit.sources.files import materialize

T0 = datetime(2024, 1, 1)
HORIZON = 30


def at(h):
    return T0 + timedelta(hours=h)


def intervals(rng, name, gaps=True):
    """Intervals of a key that do not overlap, with holes and rows of no length."""
    points = sorted(rng.sample(range(HORIZON), rng.randint(0, 8)))
    rows = []
    for i, (a, b) in enumerate(zip(points, points[1:])):
        if gaps and rng.random() < 0.25:
            continue
        if rng.random() < 0.2:
            rows.append((a, a, f"{name}{i}-gone"))
        else:
            rows.append((a, b, f"{name}{i}"))
    return rows


def spliced(old, new):
    """By looking at every hour."""
    def row_at(rows, t):
        return next((r for r in rows if r[0] <= t < r[1]), None)

    out, before = [], None
    for t in range(HORIZON):
        row = row_at(new, t) or row_at(old, t)
        key = row and (row in new, row)
        if key and key == before:
            out[-1][1] = t + 1
        elif row:
            out.append([t, t + 1, row[2]])
        before = key
    starts = {r[0] for r in new}
    out += [[a, b, v] for a, b, v in new if a == b]
    out += [[a, b, v] for a, b, v in old if a == b and not row_at(new, a) and a not in starts]
    return sorted(map(tuple, out))


def test_splice_equals_looking_at_every_hour(spark):
    rng = random.Random(5)
    sides = {k: (intervals(rng, "o"), intervals(rng, "n")) for k in range(150)}
    schema = "k int, v string, a timestamp_ntz, b timestamp_ntz"
    old, new = (spark.createDataFrame([(k, v, at(a), at(b)) for k, s in sides.items() for a, b, v in s[i]], schema) for i in (0, 1))
    got = defaultdict(list)
    for r in splice(old, new, ["k"], "a", "b").collect():
        got[r.k].append(tuple(int((x - T0).total_seconds()) // 3600 for x in (r.a, r.b)) + (r.v,))
    for k, (o, n) in sides.items():
        assert sorted(got[k]) == spliced(o, n), (o, n)
    assert splice(old.limit(0), new.limit(0), ["k"], "a", "b").collect() == []


def test_bucket_table_reads_and_writes_its_buckets_only(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("k",), 8)
    assert not table.exists(spark)
    table.write(spark.createDataFrame([(i, f"a{i}") for i in range(40)] + [(None, "null")], "k int, v string"))
    assert table.exists(spark) and table.read(spark).count() == 41
    batch = spark.createDataFrame([(3, "b3"), (99, "b99")], "k int, v string")
    touched = table.touched(batch)
    files_of = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    before = files_of()
    table.replace(spark.createDataFrame([(3,), (4,), (99,)], "k int"), batch)
    after = files_of()
    rewritten = {*touched, *table.touched(spark.createDataFrame([(4,)], "k int"))}
    assert {p for p in before if int(p.parent.name.split("=")[1]) not in rewritten} == set(before) & set(after)
    want = {(i, f"a{i}") for i in range(40) if i not in (3, 4)} | {(3, "b3"), (99, "b99"), (None, "null")}
    assert {tuple(r) for r in table.read(spark).collect()} == want
    found = table.of_keys(batch.select("k"))
    assert {tuple(r) for r in found.collect()} == {(3, "b3"), (99, "b99")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"{BUCKET}#" in plan and "PartitionFilters: [" in plan and all(str(b) in plan.split("PartitionFilters: [")[1].split("]")[0] for b in touched)
    every = table.read(spark).select("k").distinct()
    table.replace(every, batch.limit(0))
    assert {tuple(r) for r in table.read(spark).collect()} == {(None, "null")}


def test_appended_loads_repeat_and_stay_apart(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("k",), 4)
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    table.append(rows((1, "a"), (2, "b")), 1)
    table.append(rows((1, "x"), (3, "y")), 2)
    table.append(rows((1, "c")), 2)
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, "a"), (1, "c"), (2, "b")]
    assert sorted(r.v for r in table.of_keys(rows((1, "")), before=2).collect()) == ["a"]


def closure(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "cycle", "hubs"])
def test_components_equal_union_find(spark, shape):
    rng = random.Random(shape)
    edges = {
        "chain": [(i, i + 1) for i in range(200)],
        "star": [(500, i) for i in range(100)] + [(0, 600)],
        "random": [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(120)],
        "cycle": [(i, (i + 1) % 50) for i in range(50)] + [(70, 70), (71, 72), (72, 71)],
        "hubs": [(900 + h, 10 * h + i) for h in range(8) for i in range(12)],
    }[shape]
    names = rng.sample(range(1000), 1000)
    edges = [(f"p{names[a]:04d}", f"p{names[b]:04d}") for a, b in edges]
    df = spark.createDataFrame([*edges, (None, "p1"), ("p1", None)], "a string, b string")
    got = {r.node: r.root for r in components(df, materialize).collect()}
    assert got == {x: r for x, r in closure([e for e in edges if e[0] != e[1]]).items()}


def test_links_of_shared_values(spark):
    df = spark.createDataFrame([(i, "all" if i else None, i % 3) for i in range(30)], "id long, x string, y int")
    links = shared_value_links(df, "id", ["x", "y"])
    assert links.count() == len({(1, i) for i in range(2, 30)} | {(i % 3, i) for i in range(3, 30)})
    assert {r.root for r in components(links, materialize).collect()} == {0}


PERSON = """person_id string, source string, individual_id string, state string, primary_identity_id long, primary_legacy_account_id long"""


def test_merged_persons_point_to_survivors(spark):
    rows = [("a", "identity", None, "active", 1, None), ("b", "legacy", "i1", "active", None, 7), ("c", "legacy-account", None, "active", None, 9),
            ("d", "primary", "i2", "active", None, None), ("e", "identity", None, "active", 5, None), ("f", None, None, "active", None, None)]
    person = spark.createDataFrame(rows, PERSON)
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("f", "unknown"), ("unknown", "e")], "a string, b string")
    labels = rs.Labels(person="primary")
    got = {r.person_id: r for r in rs.merge_persons(person, links, materialize, labels).collect()}
    assert [got[p].merged_person_id for p in "abcdef"] == ["d", "d", "d", None, None, "e"]
    assert (got["d"].primary_identity_id, got["d"].primary_legacy_account_id) == (1, 7)
    assert (got["b"].primary_legacy_account_id, got["b"].prior_primary_legacy_account_id, got["b"].state) == (None, 7, "merged")
    assert got["e"].state == "active" and got["e"].prior_primary_identity_id is None
    alone = rs.merge_persons(person, links.limit(0), materialize, labels)
    assert alone.where("merged_person_id is not null").count() == 0 and alone.count() == len(rows)


def test_person_versions_close_and_repeat(spark):
    one = spark.createDataFrame([("a", "x"), ("b", "y")], "person_id string, v string")
    first = person_versions(None, one, "2024-01-01")
    second = person_versions(first.where("person_id = 'a'"), one.where("person_id = 'a'").withColumn("v", F.lit("z")), "2024-01-02")
    again = person_versions(second, one.where("person_id = 'a'").withColumn("v", F.lit("z")), "2024-01-02")
    rows = sorted((r.v, str(r.valid_from_est_timestamp), str(r.valid_to_est_timestamp), r.is_current) for r in again.collect())
    assert rows == [("x", "2023-12-31 19:00:00", "2024-01-01 19:00:00", False), ("z", "2024-01-01 19:00:00", OPEN_END, True)]


def test_watermark_is_seen_while_rows_are_written(spark, tmp_path):
    """Rows that arrive in the source after the load read it are not passed by the watermark."""
    source, mark = str(tmp_path / "s"), str(tmp_path / "w")
    spark.createDataFrame([(1, at(1)), (2, at(2))], "id int, ts timestamp_ntz").write.parquet(source)
    rows, seen = watermark.observed_maximum(spark.read.parquet(source), "ts")
    materialize(rows, "load")
    spark.createDataFrame([(3, at(3))], "id int, ts timestamp_ntz").write.mode("append").parquet(source)
    assert watermark.store_observed(spark, seen, mark) == at(2) == watermark.read_watermark(spark, mark)
    left = watermark.newer_than(spark.read.parquet(source), "ts", watermark.read_watermark(spark, mark))
    assert [r.id for r in left.collect()] == [3]
    rows, seen = watermark.observed_maximum(spark.read.parquet(source).where("id > 9"), "ts")
    materialize(rows, "load")
    assert watermark.store_observed(spark, seen, mark) is None and watermark.read_watermark(spark, mark) == at(2)


def test_delta_reads_only_its_buckets_of_closed_rows(spark, tmp_path):
    base = str(tmp_path / "h")
    rows = spark.createDataFrame([(i, j, j == 2) for i in range(50) for j in range(3)], "k int, v int, cur boolean")
    files.write_history(rows, base, 1, F.col("cur"), ["k"], 16)
    batch = spark.createDataFrame([(7,), (8,)], "k int")
    found = files.read_buckets_of(batch, base, ["k"])
    keys = {r.k for r in found.collect()}
    assert {7, 8} <= keys and len(keys) < 25 and found.count() == 3 * len(keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files.append_history(spark.createDataFrame([(7, 3, True), (7, 2, False)], rows.schema), base, 2, F.col("cur"), ["k"])
    assert sorted((r.v, r.cur) for r in files.read_buckets_of(batch, base, ["k"]).where("k = 7").collect()) == [(0, False), (1, False), (2, False), (3, True)]


def test_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    table = BucketTable(f"{tmp_path}/t", ("k",), 1)
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table.write(rows)
    assert len(list((tmp_path / "t" / f"{BUCKET}=0").glob("*.parquet"))) > 1
    assert table.read(spark).columns == ["k", "v"] and table.read(spark).exceptAll(rows).isEmpty() and table.read(spark).count() == 200_000
    few = spark.range(10).withColumnRenamed("id", "k")
    table.replace(few, few.where("k < 5").withColumn("v", F.lit("new")))
    assert table.read(spark).count() == 199_995 and table.read(spark).where("v = 'new'").count() == 5


def test_newest_load_joins_nothing(spark):
    rows = [(1, at(0), "a", 1), (1, at(0), "b", 2), (1, at(0), "c", 2), (1, at(1), "d", 1), (2, at(0), "e", 1), (2, at(0), "f", None)]
    rows += [(None, at(0), "g", 3), (3, None, "h", 3), (4, at(0), "i", None)]
    out = newest_load(spark.createDataFrame(rows, "k int, t timestamp_ntz, v string, _load int"), ["k", "t"])
    assert out.columns == ["k", "t", "v"]
    assert sorted(r.v for r in out.collect()) == ["b", "c", "d", "e"]
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(k") == 1
