"""Segmented scans against plain windows, and digest syncs against the plain sync."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from histkit.operators import digests, joins, merge, segments, windows
from histkit.sources.files import materialize


def table(spark, seed, n=600):
    """Half of all rows are of one key at one time; values, times and keys may be null."""
    rng = random.Random(seed)
    rows = [("hot", 5, rng.choice([None, rng.randint(0, 3)]), i) for i in range(n // 2)]
    rows += [(rng.choice(["a", "b", "c", None, "hot"]), rng.choice([None, *range(9)]), rng.choice([None, 1, 2]), n + i) for i in range(n // 2)]
    rows += rows[:3]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, v int, id int").repartition(7)


def result(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("parts", [1, 6, 40])
def test_scans_equal_windows(spark, parts):
    df = table(spark, parts).dropDuplicates()
    keys, order = ["k"], ["t", "id"]
    for mine, plain in ((segments.previous_value, windows.previous_value), (segments.next_value, windows.next_value)):
        assert result(mine(df, keys, order, "v", "out", materialize, parts)) == result(plain(df, keys, order, "v", "out"))
    fills = {"x": "v", "y": F.col("v") + 1}
    assert result(segments.forward_fill(df, keys, order, fills, materialize, parts)) == result(windows.forward_fill(df, keys, order, fills))


def test_no_range_grows_with_a_key(spark):
    df = table(spark, 3, 4000)
    rows = segments.segmented(df, ["k"], ["t"], materialize, 16)
    sizes = [r["count"] for r in rows.groupBy("_segment").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * 4000 / 16
    ties = segments.previous_value(df, ["k"], ["t"], "t", "before", materialize, 16)
    assert ties.where("before > t").count() == 0 and ties.where("before is null and t is not null").count() <= 5
    assert ties.count() == df.count()


def test_changes_and_point_in_time_joins(spark):
    df = table(spark, 8).dropDuplicates().withColumn("gone", F.col("v") == 2)
    got = segments.changed_rows(df, ["k"], ["t", "id"], ["v"], materialize, "gone", 9)
    over = Window.partitionBy("k").orderBy("t", "id")
    state = F.struct("v", F.coalesce("gone", F.lit(False)).alias("g"))
    want = df.withColumn("b", F.lag(state).over(over)).where(F.col("b").isNull() | ~F.col("b").eqNullSafe(state) | F.col("gone")).drop("b")
    assert result(got) == result(want)
    spine = df.select("k", "id", F.timestamp_seconds(F.coalesce("t", F.lit(0))).alias("at"))
    history = spark.createDataFrame([("hot", 0, 5, "x"), ("hot", 5, 6, "y"), ("a", 2, 4, "z"), (None, 0, 9, "n")], "k string, f int, u int, w string")
    history = history.select("k", F.timestamp_seconds("f").alias("f"), F.timestamp_seconds("u").alias("u"), "w")
    mine = segments.pit_join(spine, history, ["k"], "at", {"got": "w"}, "f", "u", materialize, 11)
    assert result(mine) == result(joins.pit_join(spine, history, ["k"], "at", {"got": "w"}, "f", "u"))


def test_empty_scan(spark):
    df = table(spark, 1).limit(0)
    assert segments.previous_value(df, ["k"], ["t"], "v", "out", materialize).collect() == []


def sides(spark):
    target = spark.createDataFrame([(i, f"v{i}", "kept") for i in range(500)] + [(None, "null", "kept")], "k int, v string, note string")
    stage = [(i, f"v{i}") for i in range(500) if i not in (7, 80)] + [(900, "new"), (901, None)]
    stage = [(k, "changed" if k == 33 else None if k == 44 else v) for k, v in stage]
    return target, spark.createDataFrame(stage, "k int, v string")


def test_sync_by_digest_equals_sync(spark):
    target, stage = sides(spark)
    for coarse, fine in ((1, 1), (8, 64), (64, 4096)):
        got = digests.sync_by_digest(target, stage, ["k"], coarse=coarse, fine=fine)
        assert result(merge.merged_rows(got)) == result(merge.merged_rows(merge.sync(target, stage, ["k"])))
    actions = {r.action: r.row_count for r in merge.merge_metrics(digests.sync_by_digest(target, stage, ["k"])).collect()}
    assert actions["keep"] > 450 and actions["insert"] == 2 and actions["delete"] == 3


def test_equal_tables_have_no_bucket_to_join(spark):
    target, _ = sides(spark)
    target = target.where("k is not null")
    stage = target.select("k", "v").orderBy(F.desc("k"))
    assert digests.different_buckets(target, stage, ["k"], ["v"]) == []
    plan = digests.sync_by_digest(target, stage, ["k"])
    assert {r.action for r in merge.merge_metrics(plan).collect()} == {"keep"}
    twice = stage.unionByName(stage.where("k < 2"))
    assert len(digests.different_buckets(target, twice, ["k"], ["v"])) == 2
    with pytest.raises(ValueError):
        digests.different_buckets(target, stage, ["k"], ["v"], coarse=10, fine=15)


def test_only_differing_buckets_reach_the_join(spark):
    target, stage = sides(spark)
    target = target.where("k is not null")
    touched = digests.different_buckets(target, stage, ["k"], ["v"], 8, 64)
    assert 0 < len(touched) <= 6
    plan = digests.sync_by_digest(target, stage, ["k"], coarse=8, fine=64)._jdf.queryExecution().optimizedPlan().toString()
    assert all(str(b) in plan for b in touched) and "Join" in plan
