import math
import re
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, awkward, documents, prose
from pyspark.sql import functions as F

from histkit.llm.mixing import mix, mixed_rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes: dict) -> dict:
    """Rounds of sharing the excess by weight, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not above:
            return target | {s: level * weight[s] for s in open_}
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def many(spark):
    rows = [(i, prose(i, 1 + i * 37 % 400), "en", "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(600)]
    return documents(spark, rows + [(1000 + i, prose(i, 9), "en", None) for i in range(20)])


@pytest.mark.parametrize("table", [awkward, many])
def test_sources_come_to_their_targets(spark, table):
    docs = table(spark)
    rows = mix(docs.withColumns({"size": F.lit("x"), "key": F.lit(1)})).collect()
    assert len(rows) == docs.count()
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(WORDS.findall(r.text or "")) and 0 <= r.taken <= 2 * r["size"]
        assert r.taken == r.copies * r["size"] + r.extra
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2  # words; repeated border rows round down


def test_reruns_agree_and_keys_order_the_fraction(spark):
    docs = many(spark)
    first, again = (sorted((r.doc_id, r.taken) for r in mix(d).collect()) for d in (docs, docs.repartition(7)))
    assert first == again
    low = mix(docs, quality=F.when(F.col("doc_id") % 2 == 0, 50.0).otherwise(1.0), weights=(1,), share=0.3)
    by = defaultdict(list)
    for r in low.where("size > 0").collect():
        by[r.doc_id % 2].append(r.taken / r["size"])
    assert sum(by[0]) / len(by[0]) > 3 * sum(by[1]) / len(by[1])


def test_rows_of_the_mix_are_whole(spark):
    docs = many(spark)
    counts = Counter(r.doc_id for r in mixed_rows(docs).collect())
    whole = {r.doc_id: r.copies + int(r.extra > 0) for r in mix(docs, whole=True).collect()}
    assert counts == Counter({k: v for k, v in whole.items() if v})
    assert mixed_rows(docs).columns == docs.columns


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mix(empty).collect() == [] and mixed_rows(empty).collect() == []
    assert [r.taken for r in mix(documents(spark, [(1, None, None, None)])).collect()] == [0]
