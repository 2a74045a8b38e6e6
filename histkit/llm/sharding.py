"""Sharding by sampled splitters, with sizes near equal.

Rows are ordered by a hash of their text, so equal texts have one key. Keys sampled in
proportion to size give quantile boundaries of many narrow ranges, whose exact sizes are
counted. Overfull ranges are subdivided: keys that are heavier than an ideal range become ranges
of their own, and a key that is heavier than a shard's share is dealt to several by a number
that each row gets, as ids may repeat or be missing. The ranges (a bounded number, whatever the input's size) then go to
shards, largest first to the emptiest.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from histkit.llm.common import store

#: Ranges per shard, sampled keys per range, pieces of a shard's share that a heavier key is dealt in.
RANGES = 64
SAMPLES = 8
PIECES = 32
#: Rows of a unit that are numbered together, on average.
NUMBERED = 8192


def sized_rows(docs: DataFrame) -> DataFrame:
    """row (a number of its own), doc_id, size (UTF-8 bytes and 16), text_crc32 and key; a null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("key"))


def splitters(rows: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Boundaries at the quantiles of keys that are drawn with a chance in proportion to size,
    about ``ranges * SAMPLES`` of them for any input: each row is drawn on its own, so repeated
    rows do not come together."""
    drawn = ranges * SAMPLES / max(total, 1)
    chance = (F.shiftrightunsigned(F.xxhash64("row", F.lit(1)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    keys = np.sort([r.key for r in rows.where(chance < F.col("size") * drawn).select("key").collect()])
    return np.unique(keys[SAMPLES::SAMPLES]) if len(keys) else np.zeros(0, np.int64)


def emptiest_first(sizes: list[int], shards: int) -> list[int]:
    """The shard of each unit: largest first, to the shard with the least so far."""
    heap = [(0, s) for s in range(shards)]
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        full, shard = heapq.heappop(heap)
        out[k] = shard
        heapq.heappush(heap, (full + sizes[k], shard))
    return out


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in the shard) of each row.

    Equal texts share a shard unless they alone are more than its fair share. A null text is
    empty, a null doc_id is allowed, repeated rows each get a slot, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = store(sized_rows(docs), "sized")
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = shards * RANGES
    bounds = spark.sparkContext.broadcast(splitters(rows, total, ranges).astype(np.int64))

    @F.pandas_udf(T.IntegerType())
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds.value, keys.to_numpy(np.int64), "right").astype(np.int32))

    ideal, share = total / ranges, total / shards
    in_ranges = store(rows.withColumn("range", range_of("key")), "ranges")
    overfull = in_ranges.groupBy("range").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > 2 * ideal).select("range")
    heavy = in_ranges.join(F.broadcast(overfull), "range").groupBy("key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > ideal)
    # Each heavy key has more than 1 / ranges of all bytes, so there are fewer than `ranges`.
    pieces = F.when(F.col("bytes") > share, F.ceil(F.col("bytes") / (share / PIECES))).otherwise(1) if share else F.lit(1)
    heavy = store(heavy.select(F.col("key").alias("heavy_key"), pieces.cast("long").alias("pieces")), "heavy-keys")
    unit = F.when(F.col("heavy_key").isNull(), F.struct(F.col("range").cast("long").alias("a"), F.lit(-1).cast("long").alias("b")))
    unit = unit.otherwise(F.struct(F.col("heavy_key").alias("a"), F.pmod(F.xxhash64("row"), F.col("pieces")).alias("b")))
    in_units = in_ranges.join(F.broadcast(heavy), F.col("key") == F.col("heavy_key"), "left").select("row", "doc_id", "size", "text_crc32", unit.alias("unit"))
    in_units = store(in_units.select("row", "doc_id", "size", "text_crc32", "unit.a", "unit.b"), "units")
    units = in_units.groupBy("a", "b").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).orderBy("a", "b").collect()
    of_unit = emptiest_first([u.bytes for u in units], shards)
    plan = spark.createDataFrame([(u.a, u.b, s, math.ceil(u.n / NUMBERED)) for u, s in zip(units, of_unit)], "a long, b long, shard int, cells int")
    # The plan has a row for each unit: a bounded number.
    celled = in_units.join(F.broadcast(plan), ["a", "b"]).withColumn("cell", F.pmod(F.xxhash64("row"), F.col("cells")))
    cells = celled.groupBy("shard", "a", "b", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("a", "b", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("a", "b", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("a", "b", "cell").orderBy("row"))
    numbered = celled.join(starts, ["a", "b", "cell"]).withColumn("slot", F.col("start") + nth - 1)
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot")
