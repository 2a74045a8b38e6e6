"""Cut windows give what plain windows give, also with null keys and a dominant key."""

import random

import pytest
from pyspark.sql import functions as F

from histkit.operators import windows as wd


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        key = None if i % 37 == 0 else ("hot" if rng.random() < 0.5 else f"k{rng.randrange(12)}")
        rows.append((i, key, rng.randrange(60), rng.choice([None, "a", "b", "c"])))
    return spark.createDataFrame(rows, "id int, key string, at int, value string").cache()


SLICES = {"wide": "floor(at / 20)", "narrow": "floor(at / 2)", "all": "1"}


# Keys with more than this many rows are cut: the dominant one, or all of them.
HOT = 20


def rows(df):
    return sorted(tuple(r) for r in df.select("id", *sorted(c for c in df.columns if c.startswith("o"))).collect())


@pytest.mark.parametrize("cut", sorted(SLICES))
def test_previous_and_next(log, cut):
    for fn in (wd.previous_value, wd.next_value):
        plain = fn(log, ["key"], ["at", "id"], F.col("value"), "o")
        sliced = fn(log, ["key"], ["at", "id"], F.col("value"), "o", F.expr(SLICES[cut]), HOT)
        assert sliced.columns == plain.columns
        assert rows(sliced) == rows(plain)


@pytest.mark.parametrize("cut", sorted(SLICES))
def test_forward_fill(log, cut):
    values = {"o1": F.col("value"), "o2": F.when(F.col("at") % 5 == 0, F.col("id"))}
    plain = wd.forward_fill(log, ["key"], ["at", "id"], values)
    sliced = wd.forward_fill(log, ["key"], ["at", "id"], values, F.expr(SLICES[cut]), HOT)
    assert rows(sliced) == rows(plain)


def test_hot_key_is_spread_over_tasks(spark):
    """No window over the rows themselves is partitioned by the key alone."""
    df = spark.range(1000).select(F.lit(1).alias("key"), F.col("id").alias("at"), F.col("id").alias("v"))
    out = wd.previous_value(df, ["key"], ["at"], F.col("v"), "p", F.floor(F.col("at") / 100), 100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and "_slice" in plan
    assert out.where("p is null").count() == 1


def test_only_big_shares_are_hot(spark):
    df = spark.range(100_000).selectExpr("if(id % 3 = 0, -1, id % 20000) as key")
    assert [r.key for r in wd.hot_keys(df, ["key"], 4).collect()] == [-1]
    assert wd.hot_keys(df, ["key"]).count() == 0


@pytest.mark.parametrize("cut", sorted(SLICES))
@pytest.mark.parametrize("hot", [HOT, 10_000])
def test_ties_do_not_depend_on_size(log, cut, hot):
    """Many rows share a time, also at the border of a slice, and the order says no more."""
    tied = log.select("id", "key", (F.col("at") / 10).cast("int").alias("at"), "value")
    for fn in (wd.previous_value, wd.next_value):
        plain = fn(tied, ["key"], ["at"], F.col("id"), "o")
        assert rows(fn(tied.repartition(5), ["key"], ["at"], F.col("id"), "o", F.expr(SLICES[cut]), hot)) == rows(plain)
    values = {"o1": F.col("value")}
    plain = wd.forward_fill(tied, ["key"], ["at"], values)
    assert rows(wd.forward_fill(tied.repartition(5), ["key"], ["at"], values, F.expr(SLICES[cut]), hot)) == rows(plain)
