"""The registered queries on the smallest tables, against brute force, and the pipeline stage by stage."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_links import closure, plain_fingerprint
from test_mixing import targets
from test_secretscan import plain_base

import __spark_entry__ as spark_entry
import corpus_pipeline

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
QUERIES = spark_entry.queries()


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r for r in table(spark, sf_dir, "documents").collect()}


def test_all_queries_are_registered():
    numbers = sorted(int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def types(df):
    return dict(df.dtypes)


def test_pack_and_shard(spark, sf_dir, texts):
    pieces = QUERIES["op1_pack"](spark, sf_dir)
    assert {c: types(pieces)[c] for c in ("start", "sequence_id", "ids_crc32")} == dict.fromkeys(("start", "sequence_id", "ids_crc32"), "bigint")
    rows = pieces.collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert all(sum(r.length for r in rows if r.doc_id == i) == next(r.doc_tokens for r in rows if r.doc_id == i) for i in list(texts)[:50])
    full = Counter()
    for r in rows:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 2048 and sum(full.values()) > 0.97 * 2048 * len(full)
    shards = QUERIES["op5_shard"](spark, sf_dir)
    assert types(shards)["shard"] == types(shards)["grown_shard"] == "int" and types(shards)["slot"] == "bigint"
    rows = shards.collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {i: (len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for i, d in texts.items()}
    assert {r.law for r in rows} == {"bytes"}


def test_mix(spark, sf_dir, texts):
    rows = QUERIES["op2_mix"](spark, sf_dir).collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(WORDS.findall(texts[r.doc_id].text or "")) and 0 <= r.taken <= 2 * r["size"]
        sizes[texts[r.doc_id].source] += r["size"]
        taken[texts[r.doc_id].source] += r.taken
    want = targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert all(math.isclose(r.target, want[texts[r.doc_id].source], rel_tol=1e-9) for r in rows)


def test_secrets(spark, sf_dir, texts):
    for r in QUERIES["op3_secrets"](spark, sf_dir).collect():
        kinds = [k for _, k, _ in plain_base(texts[r.doc_id].text or "")]
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds.count(0), kinds.count(1), kinds.count(2))


def test_embeddings(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").orderBy("vec_id").collect()
    ids = [r.vec_id for r in rows]
    x = np.array([r.embedding for r in rows], dtype=float)
    label = np.array([r.label for r in rows])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    root = closure(len(ids), list(zip(*np.nonzero(near))))
    found = QUERIES["op4_near_embeddings"](spark, sf_dir).orderBy("vec_id").collect()
    assert [(r.vec_id, r.n_links, r.component_id) for r in found] == [(v, int(near[i].sum()), ids[root[i]]) for i, v in enumerate(ids)]
    whole = np.floor(256 * x).astype(int)
    want = []
    for i, v in enumerate(ids):
        if v % 50 == 0:
            best = sorted((-int(whole[i] @ whole[j]), ids[j]) for j in range(len(ids)) if j != i)[:5]
            want += [(v, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    found = QUERIES["op9_top_k"](spark, sf_dir).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == sorted(want)


def test_models_on_the_tables(spark, sf_dir, texts):
    labels = {r.doc_id: r for r in table(spark, sf_dir, "labels").collect()}
    quality = {r.doc_id: r for r in QUERIES["op6_quality"](spark, sf_dir).collect()}
    assert set(quality) == set(texts)
    judged = [(labels[i].quality, r.kept) for i, r in quality.items() if i in labels]
    assert sum(k for q, k in judged if q == 1) >= 0.97 * sum(q == 1 for q, _ in judged)
    toxic = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, sf_dir).collect()}
    assert set(toxic) == set(texts)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 for i, r in toxic.items())
    clean = [r for i, r in toxic.items() if i in labels and labels[i].toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_pages(spark, sf_dir):
    rows = QUERIES["op10_html_text"](spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "pages").count() and all(r.text for r in rows)


def test_pipeline_stages(spark, sf_dir, texts, tmp_path):
    docs = table(spark, sf_dir, "documents")
    before, columns = {i: d.text for i, d in texts.items()}, docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "quality classifier":
            assert {r.doc_id for r in rows} <= set(before) and len(rows) < len(before)
            after = {r.doc_id: r.text for r in rows}
            assert all(before[i] == t for i, t in after.items())
        elif name == "SimHash near-dedup":
            ids = sorted(before)
            fps = [plain_fingerprint(before[i]) for i in ids]
            links = [(i, j) for i in range(len(ids)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
            root = closure(len(ids), links)
            after = {r.doc_id: r.text for r in rows}
            assert sorted(after) == sorted({ids[r] for r in root}) and len(rows) == len(after)
        elif name == "secret scans":
            after = {r.doc_id: r.text for r in rows}
            assert set(after) == set(before)
            assert not any(plain_base(t or "") for t in after.values())
            assert all(after[i] == t for i, t in before.items() if "[SECRET]" not in after[i])
            assert all(r.n_chars == len(r.text) for r in rows if "[SECRET]" in (r.text or ""))
        elif name == "mixing sources":
            counts, after = Counter(r.doc_id for r in rows), before
            assert max(counts.values()) == 2 and set(counts) <= set(before)
            source = {i: texts[i].source for i in before}
            size = {i: len(WORDS.findall(t or "")) for i, t in before.items()}
            total, taken = Counter(), Counter()
            for i in before:
                total[source[i]] += size[i]
                taken[source[i]] += counts[i] * size[i]
            longest = {s: max(size[i] for i in before if source[i] == s) for s in total}
            assert all(abs(taken[s] - t) <= longest[s] / 2 + 1 for s, t in targets(total).items())
        else:
            assert Counter(r.doc_id for r in rows if r.start == 0) == counts
        before = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset", "sequence_tokens", "padded_length").collect())) == sorted(
        map(tuple, docs.drop("sequence_id", "offset", "sequence_tokens", "padded_length").collect())
    )
