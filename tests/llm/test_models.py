import math
import random

import numpy as np
import pytest
from helpers import DOCS, awkward, documents, prose
from pyspark.sql import functions as F

from histkit.llm import quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


def labelled(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(700):
        bad, toxic = i % 7 == 0, i % 5 == 0
        words = prose(i, 40 + i % 50, 3000).split()
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["idiot", "schund" + rng.choice(["en", "haft", "lich"]), "moron!"])
        text = " ".join(w + "###" for w in words) if bad else " ".join(words)
        rows.append((i, text, "en", "bad-site" if bad else f"s{i % 4}"))
        labels.append((i, int(not bad), int(toxic)))
    return documents(spark, rows), spark.createDataFrame(labels, LABELS)


def test_quality_rejects_bad_and_keeps_good(spark):
    docs, labels = labelled(spark)
    rows = quality.classify(docs, labels.where("doc_id % 2 = 0")).where("doc_id % 2 = 1").collect()
    assert len(rows) == 350 and all(r.kept == (r.doc_id % 7 != 0) for r in rows)
    kept = quality.good_rows(docs.withColumn("quality", F.lit("mine")), labels)
    assert set(kept.columns) == {*docs.columns, "quality"} and kept.where("quality <> 'mine'").count() == 0
    assert kept.count() == 600


def test_site_shares_shrink_toward_their_parents(spark):
    rows = [("h1", "a", 0.9)] * 400 + [("h1", "b", 0.1)] * 2 + [("h2", "a", 0.2)] * 400 + [(None, None, 0.5)] * 3 + [("h3", "a", 0.8)] * 300
    shift = {(r.host, r.path): r["shift"] for r in quality.site_odds(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    share = sum(p for *_, p in rows) / len(rows)
    odds = {k: 1 / (1 + math.exp(-(s + math.log(share / (1 - share))))) for k, s in shift.items()}
    assert abs(odds["h1", "a"] - 0.9) < 0.05 and abs(odds["h2", "a"] - 0.2) < 0.05
    assert odds["h1", "b"] > 0.3  # two rows move little from the host's share
    assert abs(odds[None, None] - share) < abs(0.2 - share)


def test_quality_of_awkward_rows(spark):
    docs = awkward(spark).withColumns({"kept": F.lit("x"), "site_host": F.lit(1)})
    none = spark.createDataFrame([], LABELS)
    rows = quality.classify(docs, none).collect()
    assert len(rows) == docs.count() and all(r.kept and 0 <= r.quality <= 1 for r in rows)
    assert quality.classify(spark.createDataFrame([], DOCS), none).collect() == []
    some = spark.createDataFrame([(1, 1, None), (2, 0, 1), (None, 1, 0), (2, 0, 1), (999, None, None)], LABELS)
    assert len(quality.classify(docs, some).collect()) == docs.count()


def test_fit_separates():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    good = (x[:, 2] > 0.2).astype(float)
    model = quality.fit(x, good)
    assert ((model.logit(x) > 0) == (good == 1)).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    rows = toxicity.judge(docs, labels).collect()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held) and len(held) > 150
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    flagged = next(r for r in held if r.predicted)
    assert flagged.nearest and flagged.terms


@pytest.mark.parametrize("seed", range(5))
def test_block_max_index_is_exact(seed):
    rng = random.Random(seed)
    terms = {f"t{k}": rng.uniform(1, 6) for k in range(60)}
    draw = lambda: {rng.choice(list(terms)): rng.randint(1, 4) for _ in range(rng.randint(0, 9))}
    examples = [(i, rng.randint(0, 1), draw()) for i in range(500)]
    index = toxicity.BlockMaxIndex(terms, examples, 0.1)
    of = {i: index.vector(c) for i, _, c in examples}
    for _ in range(40):
        query = index.vector(draw())
        all_ = sorted((sum(w * of[i].get(t, 0) for t, w in query.items()) for i in index.ids), reverse=True)
        want = [s for s in all_ if s > 1e-12][:25]
        assert np.allclose([s for s, _ in index.nearest(query, 25)], want)


def test_terms_with_marks_inside_are_found():
    index = toxicity.BlockMaxIndex({"abc-def": 2.0, "xy--zz": 2.0, "uvw-x-": 2.0}, [(1, 1, {"abc-def": 1})], 0.1)
    assert [set(index.vector(toxicity.terms_of(t, index.starts))) for t in ("abc-def", "xy--zz", "uvw-xyz")] == [{"abc-def"}, {"xy--zz"}, {"uvw-x-"}]
    assert index.judge("so abc-def it")[1] == "1"


def test_only_near_copies_are_left_out(spark):
    line, long = prose(9, 60, 3000), prose(8, 200, 3000)
    other = [f"{line} {prose(i, 60, 3000)}" for i in range(40, 60)]  # one line in common, mostly with the least hash
    rows = [(i, t, 1) for i, t in enumerate([*other, long, long, long + " end", None, None])] + [(90, long, 0)]
    left = toxicity.without_near_copies(spark.createDataFrame(rows, "doc_id long, text string, toxic int")).collect()
    assert sorted(r.doc_id for r in left) == [*range(21), 23, 90]


def test_toxicity_of_awkward_rows(spark):
    docs = awkward(spark).withColumns({"toxic": F.lit("x"), "score": F.lit(1)})
    for labels in ([], [(1, 1, 1), (2, 0, 0), (2, 0, 0), (None, 1, 1), (5, None, None)]):
        rows = toxicity.judge(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.judge(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).collect() == []
