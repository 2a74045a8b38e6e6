"""Comparing two tables by digests of hash buckets of the key, and joining only where they differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.functions.hashing import comparable
from histkit.operators.merge import ACTION, sync

_FINE, _COARSE = "_fine", "_coarse"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, rows, and two sums of 64-bit hashes of its rows): the same for the same rows in any order.

    Sums tell repeated rows from missing ones, which exclusive-or would not. The two hashes are
    seeded apart, so different buckets agree by chance about once in 2^128. Nulls count as values of their own.
    """
    marked = [m for c in columns for m in (F.col(c).isNull(), *comparable(df, [c]))]
    row = [F.col(k).cast("string") for k in keys] + marked
    first, second = F.xxhash64(F.lit(1), *row), F.xxhash64(F.lit(2), *reversed(row))
    wide = "decimal(38,0)"
    return df.groupBy(_bucket(keys, buckets).alias(_FINE)).agg(
        F.count("*").alias("n"), F.sum(first.cast(wide)).alias("x"), F.sum(second.cast(wide)).alias("y")
    )


def different_buckets(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], coarse: int = 64, fine: int = 4096) -> list[int]:
    """Fine buckets (``fine`` is a multiple of ``coarse``) in which the tables differ.

    Both tables are read once for the fine digests; coarse ones are sums of those. Only fine
    buckets of coarse ones that differ are compared, and at most ``fine`` numbers reach the driver.
    """
    if fine % coarse:
        raise ValueError("the number of fine buckets must be a multiple of the coarse ones")
    one, two = (bucket_digests(df, keys, columns, fine).withColumn(_COARSE, F.col(_FINE) % coarse) for df in (a, b))

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy(_COARSE).agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("n", "x", "y")])

    def differing(p: DataFrame, q: DataFrame, by: str) -> DataFrame:
        q = q.select(F.col(by).alias("_by"), *[F.col(c).alias(f"_{c}") for c in ("n", "x", "y")])
        same = F.lit(True)
        for c in ("n", "x", "y"):
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        return p.join(q, F.col(by) == F.col("_by"), "full").where(~same).select(F.coalesce(by, "_by").alias(by))

    some = [r[0] for r in differing(summed(one), summed(two), _COARSE).collect()]
    if not some:
        return []
    one, two = (d.where(F.col(_COARSE).isin(some)) for d in (one, two))
    return sorted(r[0] for r in differing(one, two, _FINE).collect())


def sync_by_digest(
    target: DataFrame, stage: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, coarse: int = 64, fine: int = 4096
) -> DataFrame:
    """:func:`histkit.operators.merge.sync` of the buckets whose digests differ; all other target rows
    are kept as they are, without a join or a shuffle.

    Digests are of the keys and the shared columns. Rows with a null key take part in the digests and in
    the sync, where they match nothing: such a bucket always differs unless both sides have none.
    """
    shared = list(columns or [c for c in stage.columns if c in target.columns and c not in keys])
    nameless = F.lit(False)
    for k in keys:
        nameless |= F.col(k).isNull()
    touched = set(different_buckets(target, stage, keys, shared, coarse, fine))
    touched |= {r[0] for df in (target, stage) for r in df.where(nameless).select(_bucket(keys, fine)).distinct().collect()}
    here = _bucket(keys, fine).isin(sorted(touched))
    kept = target.where(~here).withColumn(ACTION, F.lit("keep"))
    return sync(target.where(here), stage.where(here), keys, shared).unionByName(kept)
