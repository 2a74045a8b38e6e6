"""Point-in-time and range joins against brute force; lookups; nulls; plan shape."""

import random

import pytest
from pyspark.sql import functions as F

from histkit.functions import nested
from histkit.operators import joins as jn
from histkit.operators import quality as dq
from histkit.operators import timeline as tl
from histkit.operators.windows import next_value


@pytest.mark.parametrize("cut", [None, 7])
def test_pit_join_equals_brute_force(spark, cut):
    rng = random.Random(1)
    hist, spine = [], []
    for key in ["a", "b", None]:
        edges = sorted(rng.sample(range(100), 12))
        for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
            # Some versions end early (gaps), some are tombstones of zero length.
            end = lo if i % 5 == 4 else hi - (i % 3 == 2)
            hist.append((key, lo, end, f"{key}{i}"))
        spine += [(n, key, n % 100) for n in range(100)]
    h = spark.createDataFrame(hist, "k string, lo int, hi int, v string")
    s = spark.createDataFrame(spine, "n int, k string, at int")
    slices = F.floor(F.col("at") / cut) if cut else None
    out = jn.pit_join(s, h, ["k"], "at", {"v": "v"}, "lo", "hi", slice_by=slices, hot_rows=10)
    want = sorted(
        (n, str(k), next((v for hk, lo, hi, v in hist if k is not None and hk == k and lo <= at < hi), None)) for n, k, at in spine
    )
    assert sorted((r.n, str(r.k), r.v) for r in out.collect()) == want


def test_range_join_with_overlaps_and_open_ends(spark):
    left = spark.sql("select id as n, if(id < 0, 'z', 'a') as k, date_add(date'2024-01-01', cast(id * 9 as int)) as at from range(60)")
    right = spark.createDataFrame(
        [("a", "2023-01-01", "9999-12-31", "open"), ("a", "2024-02-01", "2024-03-05", "x"), ("a", "2024-03-05", "2024-03-05", "day"), ("b", "2024-01-01", "9999-12-31", "no")],
        "k string, lo string, hi string, v string",
    ).selectExpr("k", "date(lo) lo", "date(hi) hi", "v")
    out = jn.range_join(left, right, {"k": "k"}, "at", "lo", "hi", {"v": "v"})
    left.createOrReplaceTempView("l_side")
    right.createOrReplaceTempView("r_side")
    want = spark.sql("select l.*, r.v from l_side l left join r_side r on l.k = r.k and l.at between r.lo and r.hi")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_range_join_of_one_busy_key(spark, kind):
    rng = random.Random(7)
    base = F.lit("2024-03-01 00:00:00").cast(kind)

    def at(c):
        return base + F.make_dt_interval(secs=F.col(c))

    left = spark.createDataFrame([(i, rng.choice(["hot", "hot", "b", None]), rng.randrange(5000)) for i in range(150)], "n int, k string, s int")
    spans = [(rng.choice(["hot", "hot", "hot", "b"]), rng.randrange(5000), rng.choice([0, 5, 90, 4000, 10**9]), i) for i in range(200)]
    right = spark.createDataFrame(spans, "k string, s int, w int, v int")
    right = right.select("k", "v", "s", (F.col("s") + F.col("w")).alias("e"), at("s").alias("lo"), (at("s") + F.make_dt_interval(secs=F.col("w"))).alias("hi"))
    left = left.withColumn("at", at("s"))
    for closed in (True, False):
        out = jn.range_join(left, right, {"k": "k"}, "at", "lo", "hi", {"v": "v"}, closed)
        want = []
        for r in left.collect():
            hits = [v for k, s, w, v in spans if k == r.k and s <= r.s and (r.s <= s + w if closed else r.s < s + w)]
            want += [(r.n, v) for v in hits] or [(r.n, None)]
        assert sorted((r.n, r.v) for r in out.collect() if r.v is not None) == sorted(w for w in want if w[1] is not None)
        assert {r.n for r in out.where("v is null").collect()} == {n for n, v in want if v is None}


def test_range_join_keeps_long_versions_few(spark):
    """One key, versions as long as the history: each touches two buckets at most."""
    day = F.lit("2000-01-01").cast("timestamp_ntz")
    right = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("v"), (day + F.make_dt_interval(F.col("id"))).alias("lo"), (day + F.make_dt_interval(F.col("id") + 3000)).alias("hi"))
    left = spark.range(2).select(F.lit(1).alias("k"), (day + F.make_dt_interval(F.col("id") + 2999)).alias("at"))
    out = jn.range_join(left, right, {"k": "k"}, "at", "lo", "hi", {"v": "v"})
    assert out.groupBy("at").count().select("count").collect() == [(3000,), (3000,)]
    metrics = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(_buckets" in metrics and "NestedLoop" not in metrics and "CartesianProduct" not in metrics


def test_not_in_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in jn.not_in(df, other, "k").collect()] == [2]
    assert sorted((r.k for r in jn.missing_keys(df, other, ["k"]).collect()), key=str) == [2, None]
    assert [r.k for r in jn.present_keys(df, other, ["k"]).collect()] == [1]
    assert [r.k for r in dq.coverage_gap(df, other, ["k"]).collect()] == [2]


def test_timeline_equals_point_in_time_joins(spark):
    rng = random.Random(3)

    def source():
        pairs = {(rng.choice("ab"), rng.randrange(30)): rng.choice("xyz") for _ in range(15)}
        df = spark.createDataFrame([(k, h, v, False) for (k, h), v in pairs.items()], "k string, h int, v string, is_deleted boolean")
        df = df.withColumn("h", F.timestamp_seconds(F.col("h") * 3600).cast("timestamp_ntz"))
        df = next_value(df, ["k"], ["h"], F.col("h"), "to")
        return df.withColumn("to", F.coalesce("to", F.lit("9999-12-31").cast("timestamp_ntz"))).cache()

    sources = {n: source() for n in ("s1", "s2", "s3")}
    line = tl.timeline({n: (df, ["v"]) for n, df in sources.items()}, "k", "h", "to")
    got = sorted((r.k, r.h, *[r[n].v if r[n] else None for n in sources]) for r in line.collect())
    spine = sources["s1"].select("k", "h").union(sources["s2"].select("k", "h")).union(sources["s3"].select("k", "h")).distinct()
    for n, df in sources.items():
        spine = jn.pit_join(spine, df, ["k"], "h", {n: "v"}, "h", "to")
    assert got == sorted(map(tuple, spine.collect()))


def test_timeline_needs_one_shuffle(spark):
    df = spark.range(5).select("id", F.lit("2024-01-01").cast("timestamp_ntz").alias("h"), F.lit("v").alias("v"))
    line = tl.timeline({n: (df, ["v"]) for n in ("s1", "s2", "s3", "s4")}, "id", "h", "to")
    assert line._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_first_elements_of_empty_and_null_arrays(spark):
    df = spark.sql("select cast(array() as array<struct<source:string,id:int>>) as a union all select null")
    rows = df.select(nested.first_element("a").alias("f"), nested.first_match("a", "source", "x", "id").alias("m")).collect()
    assert all(r.f is None and r.m is None for r in rows)


def test_match_flag(spark):
    df = spark.createDataFrame([(None, None), ("a", None), ("a", "a"), ("a", "b")], "a string, b string")
    assert [r[0] for r in df.select(nested.match_flag(F.col("a"), F.col("b"))).collect()] == [None, False, True, False]


def test_quality_errors(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(dq.QualityError):
        dq.require_unique(df, ["k"])
    with pytest.raises(dq.QualityError):
        dq.require_rows(df.where("k > 5"))
    assert dq.require_rows(df) is df


def _rows_per_task(spark, df):
    """Rows that each task of the last shuffle gives, with joins that shuffle both sides."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_without_a_key_do_not_gather_in_one_task(spark):
    base = spark.range(4000).select("id", F.when(F.col("id") % 100 == 0, F.col("id")).alias("k"))
    side = spark.range(0, 4000, 100).select(F.col("id").alias("key"), F.lit("v").alias("v")).union(spark.sql("select cast(null as bigint), 'no'"))
    out = jn.enrich(base, [jn.Lookup(side, {"k": "key"}, {"v": "v"})])
    assert out.columns == ["id", "k", "v"]
    assert sorted(tuple(r) for r in out.where("v is not null").collect()) == [(i, i, "v") for i in range(0, 4000, 100)]
    assert out.count() == 4000 and max(_rows_per_task(spark, out)) < 1000


def test_range_join_of_one_width_spreads_rows_without_a_key(spark):
    left = spark.range(4000).select("id", F.when(F.col("id") < 3, F.lit(1)).alias("k"), F.lit("2024-01-05").cast("date").alias("at"))
    left = left.unionByName(spark.sql("select 9000L as id, 1 as k, cast(null as date) as at"))
    right = spark.sql(
        """select 1 as k, date'2024-01-01' as lo, date'2024-01-05' as hi, 'a' as v union all select 1, date'2024-01-04', date'2024-01-08', 'b'
        union all select null, date'2024-01-04', date'2024-01-08', 'c'"""
    )
    out = jn.range_join(left, right, {"k": "k"}, "at", "lo", "hi", {"v": "v"})
    found = sorted((r.id, r.v) for r in out.where("v is not null").collect())
    assert found == [(i, v) for i in range(3) for v in "ab"]
    assert out.count() == 4001 + 3 and max(_rows_per_task(spark, out)) < 1000
    none = jn.range_join(left, right.where("false"), {"k": "k"}, "at", "lo", "hi", {"v": "v"})
    assert none.count() == 4001 and none.where("v is not null").count() == 0
