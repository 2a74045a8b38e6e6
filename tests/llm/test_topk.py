import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from histkit.llm.topk import ImpactIndex, top_k


@pytest.mark.parametrize("seed", range(6))
def test_index_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    n, dims = int(rng.integers(1, 900)), int(rng.integers(1, 40))
    values = rng.integers(-150, 150, (n, dims)) if seed % 2 else np.repeat(rng.integers(-9, 9, (1, dims)), n, 0)
    ids = rng.permutation(n)
    index = ImpactIndex(values, np.arange(n), ids)
    for own in range(min(n, 20)):
        score = values @ values[own]
        want = sorted(((-int(score[i]), int(ids[i])) for i in range(n) if i != own))[:5]
        at, found = index.best(values[own], own, 5)
        assert [(-int(s), int(ids[a])) for a, s in zip(at, found)] == want


def test_top_k_of_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=5)]) for i in range(120)]
    rows += [(120, rows[0][1]), (10, rows[10][1]), (150, None), (200, [1.0, None, 0.0, 0.0, 0.0]), (250, [math.nan] * 5), (300, [math.inf] + [0.0] * 4), (350, [1.0]), (None, rows[2][1]), (400, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"uid": F.lit(1), "v": F.lit(2)})
    for sizes in ((16, 4), (16384, 1024)):
        found = top_k(df, F.col("vec_id") % 10 == 0, 5, rows=sizes[0], per_block=sizes[1]).collect()
        live = [(i, r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for i, r in enumerate(rows) if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
        want = []
        for i, q, v in live:
            if q is not None and q % 10 == 0:
                best = sorted((-sum(a * b for a, b in zip(v, w)), -(1 << 63) if c is None else c) for j, c, w in live if j != i and len(w) == len(v))[:5]
                want += [(q, k + 1, None if c == -(1 << 63) else c, -s) for k, (s, c) in enumerate(best)]
        assert sorted(map(str, want)) == sorted(str((r.query_id, r["rank"], r.vec_id, r.score)) for r in found)


def test_empty_table(spark):
    assert top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).collect() == []
