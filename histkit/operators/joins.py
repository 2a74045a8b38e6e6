"""Point-in-time, range, lookup and anti joins that stay linear in their inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.operators.events import Order, top_rank
from histkit.operators.windows import HOT_ROWS, forward_fill


def pit_join(
    spine: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    valid_from: str = "valid_from_date_hour",
    valid_to: str = "valid_to_date_hour",
    closed: bool = False,
    deleted: str | None = None,
    slice_by: str | Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join each spine row to the history row valid at its time: ``from <= at < to``.

    Histories of one key must not overlap, as those built here do not. Then the row valid at
    a time is the last one that started, so both sides are interleaved by time and filled
    forward: one shuffle and no comparison of every pair of rows of a key. ``take`` maps
    output names to history columns. ``closed`` allows ``at = to``. With ``deleted`` a
    tombstone stays visible until the next row of its key replaces it.

    Pass ``slice_by`` (an expression of ``at``) when a key may have more rows than one task
    can sort; see :mod:`histkit.operators.windows`.
    """
    held = [F.col(src).alias(out) for out, src in take.items()]
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    past = history.select(
        *keys,
        F.col(valid_from).alias(at),
        F.lit(0).alias("_kind"),
        F.col(valid_to).alias("_to"),
        F.struct(F.col(valid_to).alias("_to"), gone.alias("_gone"), *held).alias("_h"),
    )
    rows = spine.withColumn("_kind", F.lit(1)).unionByName(past, allowMissingColumns=True)
    order = [at, "_kind", "_to"]
    rows = forward_fill(rows, keys, order, {"_last": "_h"}, slice_by, hot_rows)
    inside = F.col(at) <= F.col("_last._to") if closed else F.col(at) < F.col("_last._to")
    valid = inside | F.col("_last._gone")
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    got = {out: F.when(valid, F.col("_last")[out]) for out in take}
    return rows.where(F.col("_kind") == 1).select(*spine.columns, *[v.alias(n) for n, v in got.items()])


# Bucket widths of a range join: a day times powers of eight, then one bucket for all time.
FINEST, STEP, WIDTHS = 86_400, 8, 6
# Numbers that rows without a key are dealt by.
SPREAD = 4096


def _seconds(df: DataFrame, c: str) -> Column:
    """Seconds of a date or timestamp on a scale without gaps, for bucketing."""
    if isinstance(df.schema[c].dataType, T.TimestampType):
        return F.unix_seconds(F.col(c))
    wall = F.col(c).cast("timestamp_ntz")
    days = F.datediff(wall.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def _spread(rows: DataFrame, unknown: Column, side: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, Column]:
    """One more equal key for a left join: 0 on both sides where ``rows`` has its keys, else a number made of the
    row's values. Rows with unknown keys meet nothing either way, but are dealt to all tasks instead of one."""
    hashed = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = rows.withColumn("_spread", F.when(unknown, F.pmod(F.xxhash64(*hashed), F.lit(SPREAD))).otherwise(F.lit(0)))
    return rows, side.withColumn("_even", F.pmod(F.xxhash64(*keys), F.lit(1))), F.col("_spread") == F.col("_even")


def range_join(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    at: str,
    lo: str,
    hi: str,
    take: Mapping[str, str],
    closed: bool = True,
) -> DataFrame:
    """Left join on equal keys and ``lo <= at <= hi`` (``< hi`` if not closed) where versions may overlap.

    Time is cut into buckets of several widths, each eight times the one before. A version is
    kept at the narrowest width that is not below its length, where it touches at most two
    buckets, so a history of *n* versions of any length becomes at most 2 *n* rows. A point in time looks once into
    each width in use, which a small job counts first. With one width a row looks into one bucket, and
    the rows are joined as they are. Otherwise points are the distinct (key, time) pairs of the left
    side; their hits are then joined back to the rows by equality, so unmatched rows are kept once.
    ``keys``: left -> right names.
    """
    def bucket(seconds: Column, n: Column) -> Column:
        width = F.element_at(F.array(*[F.lit(FINEST * STEP**k).cast("bigint") for k in range(WIDTHS)]), F.least(n + 1, F.lit(WIDTHS)))
        return F.when(n < WIDTHS, F.floor(seconds / width)).otherwise(F.lit(0)).cast("bigint")

    level = F.lit(WIDTHS)
    for n in reversed(range(WIDTHS)):
        level = F.when(F.col("_end") - F.col("_start") < FINEST * STEP**n, F.lit(n)).otherwise(level)
    # Step by step: each expression is used several times by the next, and is then not repeated in it.
    versions = right.select(
        *[F.col(r).alias(f"_k_{l}") for l, r in keys.items()],
        F.col(lo).alias("_lo"),
        F.col(hi).alias("_hi"),
        _seconds(right, lo).alias("_start"),
        _seconds(right, hi).alias("_end"),
        *[F.col(c).alias(f"_o_{o}") for o, c in take.items()],
    ).where(F.col("_lo") <= F.col("_hi"))
    versions = versions.withColumn("_level", level)
    buckets = F.array_distinct(F.array(bucket(F.col("_start"), F.col("_level")), bucket(F.col("_end"), F.col("_level"))))
    versions = versions.withColumn("_buckets", buckets).drop("_start", "_end")
    widths = sorted(r[0] for r in versions.select("_level").distinct().collect())  # at most WIDTHS + 1 numbers
    # The outer form: for the plain one Spark adds a filter that repeats the whole expression.
    versions = versions.withColumn("_bucket", F.explode_outer("_buckets")).drop("_buckets")
    clock = _seconds(left, at)

    def inside(time: Column) -> list[Column]:
        return [time >= F.col("_lo"), time <= F.col("_hi") if closed else time < F.col("_hi")]

    if len(widths) <= 1:
        unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in (*keys, at)])
        rows = left.withColumn("_b", bucket(clock, F.lit(widths[0] if widths else 0)))
        rows, versions, even = _spread(rows, unknown, versions, [f"_k_{l}" for l in keys])
        on = [F.col(l) == F.col(f"_k_{l}") for l in keys] + [F.col("_b") == F.col("_bucket"), even, *inside(F.col(at))]
        return rows.join(versions, on, "left").select(*left.columns, *[F.col(f"_o_{o}").alias(o) for o in take])

    points = left.select(*[F.col(l).alias(f"_p_{l}") for l in keys], F.col(at).alias("_p_time"), clock.alias("_clock"))
    points = points.where(F.col("_p_time").isNotNull()).distinct()
    points = points.withColumn("_n", F.explode(F.array(*[F.lit(n) for n in widths]))).withColumn("_b", bucket(F.col("_clock"), F.col("_n")))
    on = [F.col(f"_p_{l}") == F.col(f"_k_{l}") for l in keys]
    on += [F.col("_n") == F.col("_level"), F.col("_b") == F.col("_bucket"), *inside(F.col("_p_time"))]
    hits = points.join(versions, on).select(*[f"_p_{l}" for l in keys], "_p_time", *[f"_o_{o}" for o in take])
    back = [F.col(l) == F.col(f"_p_{l}") for l in keys] + [F.col(at) == F.col("_p_time")]
    return left.join(hits, back, "left").select(*left.columns, *[F.col(f"_o_{o}").alias(o) for o in take])


def latest_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """Rows of the newest snapshot, found by a scalar subquery instead of a job on the driver."""
    return df.where(F.col(snapshot) == df.agg(F.max(snapshot)).scalar())


@dataclass(frozen=True)
class Lookup:
    """One side of a chain of left joins.

    ``on`` maps columns of the rows so far to columns of this table; ``take`` maps output
    names to columns. With ``best`` the table is first reduced to one row per key in that
    order, which bounds the join's output and is exact when only the best row can survive.
    """

    df: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str | Column]
    where: Column | None = None
    best: Order | None = None
    how: str = "left"
    defaults: Mapping[str, Any] = field(default_factory=dict)


def enrich(base: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Chain of lookups; a later one may use columns taken by an earlier one.

    No side is forced to be broadcast: Spark does it for sides whose size it knows to be
    small, and splits skewed keys of the big side otherwise. Rows with a null key meet nothing
    and are dealt by their other values, so they do not gather in one task.
    """
    rows = base
    for n, lk in enumerate(lookups):
        side = lk.df if lk.where is None else lk.df.where(lk.where)
        if lk.best is not None:
            side = top_rank(side, list(lk.on.values()), lk.best)
        taken = [(F.col(c) if isinstance(c, str) else c).alias(o) for o, c in lk.take.items()]
        side = side.select(*[F.col(r).alias(f"_j{n}_{i}") for i, r in enumerate(lk.on.values())], *taken)
        cond = [F.col(l) == F.col(f"_j{n}_{i}") for i, l in enumerate(lk.on)]
        before = rows.columns
        if lk.how == "left":
            unknown = reduce(lambda a, b: a | b, [F.col(l).isNull() for l in lk.on])
            rows, side, even = _spread(rows, unknown, side, [f"_j{n}_{i}" for i in range(len(lk.on))])
            cond.append(even)
        rows = rows.join(side, cond, lk.how).select(*before, *lk.take)
        if lk.defaults:
            rows = rows.withColumns(
                {
                    c: F.coalesce(F.col(c), F.lit(v).cast(rows.schema[c].dataType))
                    for c, v in lk.defaults.items()
                }
            )
    return rows


def star_lookup(fact: DataFrame, dims: Sequence[Lookup]) -> DataFrame:
    """Resolve foreign keys of a fact against its dimensions, with unknown members as defaults."""
    return enrich(fact, dims)


def self_parent(
    df: DataFrame, parent_on: Mapping[str, str], take: Mapping[str, str], defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """Attributes of each row's parent in the same table; ``parent_on``: own column -> parent's column."""
    return enrich(df, [Lookup(df, parent_on, take, defaults=defaults or {})])


def not_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key is known and absent from the other side; nulls on the other side are ignored.

    SQL's ``NOT IN`` returns nothing as soon as the other side holds one null.
    """
    keys = other.where(F.col(other_key or key).isNotNull()).select(F.col(other_key or key).alias(key)).distinct()
    return df.where(F.col(key).isNotNull()).join(keys, key, "left_anti")


def _key_join(df: DataFrame, other: DataFrame, on: Mapping[str, str] | Sequence[str], how: str) -> DataFrame:
    """Semi or anti join against the distinct keys of the other side.

    Distinct combines before the shuffle, so a key that fills a third of the other side
    arrives once per map task.
    """
    pairs = on if isinstance(on, Mapping) else {c: c for c in on}
    side = other.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(pairs.values())]).distinct()
    return df.join(side, [F.col(l) == F.col(f"_k{i}") for i, l in enumerate(pairs)], how)


def missing_keys(df: DataFrame, other: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """``NOT EXISTS``: rows without a partner; rows with a null key are kept."""
    return _key_join(df, other, on, "left_anti")


def present_keys(df: DataFrame, other: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """``EXISTS``."""
    return _key_join(df, other, on, "left_semi")
