"""Centroid clustering against plain Lloyd rounds with Python's integers."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from histkit.llm.centroids import LARGEST, Bisectors, cluster


def exact_floor(x, scale):
    return math.floor(scale * x) if abs(x) < 2**52 else scale * int(x)


def plain(rows, clusters, rounds, dims, scale=64, seed="1"):
    kept = [(i, [exact_floor(x, scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:clusters]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[best(v)[1]].append(v)
        for k, members in groups.items():
            centres[k] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *best(v)[::-1]) for i, v in kept]
    inertia = defaultdict(int)
    for _, k, d in found:
        inertia[k] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    top = lambda x: min(x, LARGEST)
    return sorted((str(i), k, top(d), top(inertia[k]), top(sum(inertia.values())), digest[k]) for i, k, d in found)


def rows_of(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "7 as vector", "8 as cluster", "9 as hash", "10 as number")
    out = cluster(df, **more)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r.vec_id), *tuple(r)[1:]) for r in out.collect())


@pytest.mark.parametrize("seed", range(3))
def test_rounds_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 64 * (1 + seed)]) for i in range(200)]
    rows += [(200, [0.5, math.nan, 0.0, 0.0]), (201, [0.5, None, 0.0, 0.0]), (202, None), (203, []), (204, [1.0] * 5), (205, [math.inf] * 4), (None, rows[0][1]), (3, rows[3][1]), (4, rows[5][1])]
    assert rows_of(spark, rows, clusters=9, rounds=3, dims=4) == plain(rows, 9, 3, 4)


def test_huge_components_are_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) * 10.0**e for x in rng.normal(size=3)]) for i, e in enumerate([0, 3, 5, 6, 6, 7, 9, 12, 15, 0, 1, 2])]
    assert rows_of(spark, rows, clusters=4, rounds=3, dims=3) == plain(rows, 4, 3, 3)


def test_few_equal_and_no_vectors(spark):
    assert rows_of(spark, [(i, [0.25, -0.25]) for i in range(5)], dims=2) == plain([(i, [0.25, -0.25]) for i in range(5)], 16, 3, 2)
    assert rows_of(spark, [(1, [0.1, 0.2]), (2, [0.3, 0.1])], dims=2) == plain([(1, [0.1, 0.2]), (2, [0.3, 0.1])], 16, 3, 2)
    assert rows_of(spark, [], dims=2) == [] and rows_of(spark, [(1, None)], dims=2) == []


def test_zero_favours_the_smaller_number():
    planes = Bisectors([[0, 0], [2, 0], [0, 0], [1, 1]])
    winner, distance = planes.nearest(np.array([[1, 0], [1, -1], [0, 0], [2, 0]]))
    assert winner.tolist() == [0, 0, 0, 1] and distance.tolist() == [1, 2, 0, 0]
