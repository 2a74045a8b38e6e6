import zlib
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, awkward, documents, prose
from pyspark.sql import functions as F

from histkit.llm.sharding import emptiest_first, shard, sized_rows, splitters


def check(docs, shards, tolerance=None):
    rows, found = docs.collect(), shard(docs, shards).collect()
    size = lambda t: len((t or "").encode()) + 16
    want = Counter((r.doc_id, size(r.text), zlib.crc32((r.text or "").encode())) for r in rows)
    assert want == Counter((r.doc_id, r["size"], r.text_crc32) for r in found)
    slots, full, groups = defaultdict(list), Counter(), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        full[r.shard] += r["size"]
        groups[r.text_crc32, r["size"]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    total = sum(full.values())
    weight = Counter()
    for r in found:
        weight[r.text_crc32, r["size"]] += r["size"]
    assert all(len(s) == 1 for g, s in groups.items() if weight[g] <= total / shards)
    if tolerance:
        assert max(full.values()) - min(full[s] for s in range(shards)) <= tolerance * total / shards


def test_sizes_near_equal_with_a_group_of_a_third(spark):
    rows = [(i, prose(i, 5 + i % 90), "en", "s") for i in range(2000)] + [(5000 + i, prose(1, 60), "en", "s") for i in range(900)]
    check(documents(spark, rows), 8, tolerance=0.05)


@pytest.mark.parametrize("ids", ["null", "equal"])
def test_one_text_of_a_third_without_ids_of_its_own(spark, ids):
    rows = [(i, prose(i, 5 + i % 40), "en", "s") for i in range(2000)] + [(None if ids == "null" else 7, prose(1, 60), "en", "s")] * 1000
    check(documents(spark, rows), 8, tolerance=0.05)


def test_repeated_rows_are_drawn_one_by_one(spark):
    rows = sized_rows(documents(spark, [(1, "same text", "en", "s")] * 5000 + [(i, prose(i, 9), "en", "s") for i in range(50)]))
    total = rows.agg(F.sum("size")).first()[0]
    drawn = rows.where((F.shiftrightunsigned(F.xxhash64("row", F.lit(1)), 11) + F.lit(0.5)) / F.lit(float(1 << 53)) < F.col("size") * (80 / total))
    assert 40 <= drawn.count() <= 130 and len(splitters(rows, total, 10)) >= 1


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_awkward_rows(spark, shards):
    check(awkward(spark).withColumn("shard", F.lit(1)).withColumn("key", F.lit(2)), shards)


def test_empty_table_and_assignment(spark):
    assert shard(spark.createDataFrame([], DOCS)).collect() == []
    assert emptiest_first([5, 4, 3, 3, 3], 2) == [0, 1, 1, 0, 1]
