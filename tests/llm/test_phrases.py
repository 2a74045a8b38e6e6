"""Phrase collocations against counts of all runs of words."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, documents

from histkit.llm import phrases
from histkit.llm.phrases import collocations, pack_leaves, packed_groups, phrase_counts, unpack_leaves

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def plain_counts(rows):
    f, n = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in PIECE.split(text):
            words = WORD.findall(piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    return f, n


def plain(rows, least=10, share=50, top=2000):
    f, n = plain_counts(rows)
    found = {}
    candidates = {(lang, p): a for (lang, p), a in f.items() if len(p) > 1 and a >= least}
    for (lang, p), a in candidates.items():
        if any(100 * c >= share * a for (m, q), c in candidates.items() if m == lang and len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])):
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, rows in found.items() for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top]))


def rows_of(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, docs=60):
    rng = random.Random(seed)
    words = ["The", "of", "the", "New", "york", "city", "é", "日本", "a-b", "x\x1fy", "naïve"] + [f"w{i}" for i in range(12)]
    gaps = [" ", " ", " ", "\t", "  ", ". ", "\n", "!", "\x0b", " \x0c "]
    return [
        (i, "".join(w + rng.choice(gaps) for w in rng.choices(words, weights=[9] * 6 + [1] * 17, k=rng.randint(0, 150))), rng.choice(["en", "de", None, "und", "", "x\ny"]), "s") for i in range(docs)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_collocations_equal_brute_force(spark, seed):
    rows = corpus(seed)
    df = documents(spark, rows).selectExpr("*", "1 as w1", "2 as f", "3 as slot", "4 as n")
    assert rows_of(collocations(df)) == plain(rows)
    assert rows_of(collocations(df, least=2, share=90, top=7)) == plain(rows, 2, 90, 7)


def test_prefixes_are_lengthened_until_groups_fit(spark, monkeypatch):
    """Tiny budgets and rooms: slots are dealt again by two and three words, tasks hand on often."""
    rows = corpus(7, 40) + [(99, "hot word pair here " * 400, "en", "s")]
    want = plain_counts(rows)
    for name, value in (("ROOM", 50), ("SEGMENT", 64)):
        monkeypatch.setattr(phrases, name, value)
    for budget in (4, 40):
        nodes, totals = phrase_counts(documents(spark, rows), least=3, budget=budget)
        found = {(r.lang, tuple(w for w in (r.w1, r.w2, r.w3) if w is not None)): r.f for r in nodes.collect()}
        assert found == {k: c for k, c in want[0].items() if c >= 3}
        assert {r.lang: r.n for r in totals.collect()} == {k: c for k, c in want[1].items() if c}


def test_a_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 1000)
    rng = random.Random(3)
    rows = [(1, " ".join(rng.choices(["aa", "bb", "cc. ", "d" * 3000], weights=[5, 5, 2, 0.01], k=20_000)), "en", "s"), (2, "solo", "en", "s")]
    assert rows_of(collocations(documents(spark, rows))) == plain(rows)


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = [(d.doc_id, d.text, d.lang, d.source) for d in docs.collect()]
    assert rows_of(collocations(docs)) == plain(rows)
    assert rows_of(collocations(documents(spark, []))) == [] and rows_of(collocations(documents(spark, [(1, None, None, None), (2, " .. ", "en", "s")]))) == []


def test_ties_are_ranked_by_bytes(spark):
    rows = [(i, "é x. z x. Z y. ab x. 💡 x", "en", "s") for i in range(10)]
    found = rows_of(collocations(documents(spark, rows)))
    assert found == plain(rows) and [r[2] for r in found] == ["z y", "ab x", "é x", "💡 x", "z x"]


def test_packed_leaves_round_trip():
    rng = np.random.default_rng(1)
    words = [b"", b"en"] + [f"w{i}".encode() for i in range(300)]
    leaves, counts = rng.integers(0, 302, (500, 4)), rng.integers(1, 1 << 40, 500)
    ids, n, names = unpack_leaves(pack_leaves(leaves, counts, words))
    assert n.tolist() == counts.tolist() and [[names[i] for i in r] for r in ids] == [[words[i] for i in r] for r in leaves]


def test_groups_fit_the_budget():
    rng = random.Random(2)
    sizes = [rng.choice([0, 1, 5, 30, 64, 500]) for _ in range(1000)]
    groups = packed_groups(sizes, 64)
    load = Counter()
    for g, n in zip(groups, sizes):
        load[g] += n
    assert all(v <= 64 or [n for g2, n in zip(groups, sizes) if g2 == g] == [500] for g, v in load.items())
    small = [n for n in sizes if n <= 64]
    assert len(load) <= sizes.count(500) + 1.2 * sum(small) / 64 + 2
