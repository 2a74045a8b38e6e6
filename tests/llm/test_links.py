import re

import numpy as np
import pytest
import xxhash
from helpers import DOCS, awkward, documents, prose
from pyspark.sql import functions as F

from histkit.llm import covertree, simhash
from histkit.llm.covertree import CoverTree, dual_links, near_embeddings
from histkit.llm.graph import components, local_components


def closure(n, links):
    root = list(range(n))
    for _ in range(n):
        new = root[:]
        for i, j in links:
            new[i] = new[j] = min(new[i], new[j])
        if new == root:
            return root
        root = new
    return root


def test_components_of_chains_stars_and_pairs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 200), (200, 300), (5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(spark):
    base = prose(7, 400)
    rows = [(i, base + f" end{i}", "en", "s") for i in range(60)] + [(100 + i, prose(100 + i, 60), "en", "s") for i in range(80)]
    return documents(spark, rows + [(200 + i, base, "en", "s") for i in range(40)])


@pytest.mark.parametrize("table", [awkward, near_copies])
def test_simhash_groups_equal_brute_force(spark, table, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    docs = table(spark).withColumn("fp", F.lit(1)).withColumn("tile", F.lit(2))
    rows = docs.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    root = closure(len(rows), links)
    want = []
    for i, r in enumerate(rows):
        ids = [rows[k].doc_id for k in range(len(rows)) if root[k] == root[i] and rows[k].doc_id is not None]
        want.append((r.doc_id, f"{fps[i]:016x}", min(ids, default=None)))
    found = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(plain_fingerprint(r.text) for r in kept.collect()) == sorted({root[i]: fps[i] for i in sorted(range(len(rows)), key=lambda i: (rows[i].doc_id is None, rows[i].doc_id or 0), reverse=True)}.values())


def test_blocks_of_tiles(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "MANY_LINKS", 20)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 63, 12)] + [base]))
    a, b = fps[::2], fps[1::2]
    for x, y, same in ((fps, fps, True), (a, b, False)):
        nodes = x if same else np.concatenate([x, y])
        i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= 4)
        want = local_components(i, j + (0 if same else len(x)), len(nodes))
        u, v = simhash.near_in_tiles(x, y, same, 4)
        at = {f: k for k, f in enumerate(nodes)}
        found = local_components(np.array([at[f] for f in u]), np.array([at[f] for f in v]), len(nodes))
        assert (found == want).all()


@pytest.mark.parametrize("seed", range(8))
def test_dual_traversal_equals_all_pairs(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 250))
    x = rng.normal(size=(n, 8))
    centres = rng.normal(size=(4, 8))
    half = n // 2
    x[:half] = centres[rng.integers(0, 4, half)] + rng.normal(size=(half, 8)) * rng.choice([0, 0.02, 0.1, 0.3], (half, 1))
    x *= rng.uniform(0.1, 9, (n, 1))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    tree = CoverTree(x)
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    a, b, i, j = dual_links(tree, tree, 0.98, True)
    assert (a + b == near.sum(1)[tree.order]).all()
    assert (local_components(tree.order[i], tree.order[j], n) == local_components(*np.nonzero(near), n)).all()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_embedding_links(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(150):
        v = rng.normal(size=6) if i % 3 else np.ones(6) + rng.normal(size=6) * 0.15
        rows.append((i, [float(np.float32(c)) for c in v], i % 2))
    nan, inf = float("nan"), float("inf")
    odd = [(500, None, 0), (501, [0.0] * 6, 0), (502, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (503, [nan] + [1.0] * 5, 0), (504, [inf] + [1.0] * 5, 0), (505, [1.0] * 6, None), (506, [], 0), (507, [1.0] * 5, 0), (508, [1e30] * 6, 0), (3, rows[3][1], 1), (None, [1.0] * 6, 1)]
    rows += odd
    usable = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(c is not None and np.isfinite(c) for c in r[1]) and any(r[1]) for r in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                u, v = (np.array(rows[k][1], dtype=np.float32).astype(float) for k in (i, j))
                if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.98:
                    links.append((i, j))
    root = closure(len(rows), links)
    want = []
    for i, r in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if root[k] == root[i] and rows[k][0] is not None]
        want.append((r[0], sum(i in p for p in links), min(ids, default=None)))
    for block in (8, 2048):
        found = near_embeddings(vectors(spark, rows).withColumn("uid", F.lit(1)), block=block).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in found if r.vec_id is not None) == sorted(w for w in want if w[0] is not None)
        assert len(found) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert near_embeddings(vectors(spark, [])).collect() == []


def test_cells_out_of_reach_are_never_paired(spark):
    """Clusters far apart: every link is found, and few pairs of cells are looked at."""
    rng = np.random.default_rng(11)
    middles = rng.normal(size=(30, 16))
    rows = [(i, [float(np.float32(c)) for c in middles[i % 30] + rng.normal(size=16) * 0.03], i // 900) for i in range(1800)]
    rows += [(5000 + i, rows[0][1], 0) for i in range(300)]  # one vector many times
    df = vectors(spark, rows)
    found = {r.vec_id: (r.n_links, r.component_id) for r in near_embeddings(df, block=40).collect()}
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    label, ids = np.array([r[2] for r in rows]), np.array([r[0] for r in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    root = local_components(*np.nonzero(near), len(rows))
    assert found == {int(ids[k]): (int(near[k].sum()), int(ids[root[k]])) for k in range(len(rows))}

    valid = df.select(F.col("vec_id").alias("uid"), "vec_id", F.col("label").cast("string").alias("label_key"), F.lit(16).alias("dims"), F.col("embedding").cast("array<double>").alias("embedding"))
    centres = covertree.routing_centres(valid, 40, 4096)
    assert sum(map(len, centres.values())) <= 54 and len(covertree.routing_centres(valid, 40, 7)) <= 2
    placed = covertree.routed(valid, centres)
    cells = placed.groupBy("label_key", "dims", "cell").agg(F.max("far").alias("radius")).withColumn("several", F.lit(True))
    pairs, n = covertree.cells_in_reach(cells, centres, 0.98).count(), cells.count()
    assert n <= pairs < 0.5 * sum(len(c) * (len(c) + 1) / 2 for c in centres.values())


def test_empty_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).collect() == [] and simhash.without_near_duplicates(empty).collect() == []
