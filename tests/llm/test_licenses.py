"""License scans against a plain search, and against damaged copies of the templates."""

import random
import re

import pytest
from helpers import awkward, documents

from histkit.llm.licenses import BASE, OTHERS, TEMPLATES, Template, gram_rows, scan, summary

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(text):
    words = plain_words(text)
    return sorted((i, t.label) for t in BASE for i in range(len(words)) if words[i : i + len(t.words)] == t.words)


def judged(spark, texts, **more):
    rows = summary(scan(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), **more)).collect()
    return [r for r in sorted(rows, key=lambda r: r.doc_id)]


def test_base_places_equal_a_plain_search(spark):
    rng = random.Random(4)
    pool = ["gnu", "General", "PUBLIC", "license", "apache", "cc", "by", "mit", "x", "é", "by–", "v2"]
    texts = [rng.choice([" ", "-", ". "]).join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(150)]
    texts += ["MIT License", "mit license mit license", "GNU GENERAL PUBLIC LICENSE", "cc by cc by-nc", "xmit license", "mit licenses", "gnu general\npublic  license."]
    found = judged(spark, texts)
    for text, r in zip(texts, found):
        want = plain_base(text)
        assert (r.n_words, r.n_base) == (len(plain_words(text)), len(want)), text
        assert (r.first_word, r.last_word) == ((want[0][0], want[-1][0]) if want else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in want}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and r.score == (1.0 if want else r.score)


@pytest.mark.parametrize("template", [t for t in OTHERS if not t.phrase], ids=lambda t: t.label)
def test_damaged_copies_are_found_and_other_text_is_not(spark, template):
    rng = random.Random(template.label)
    words = template.words
    lead = [f"w{rng.randint(0, 99)}" for _ in range(300)]
    some = list(words)
    for i in sorted(rng.sample(range(len(some)), 3), reverse=True):  # words put in, left out and changed
        some[i : i + 1] = [some[i], "indeed"] if i % 3 == 0 else [] if i % 3 == 1 else ["other"]
    shuffled = rng.sample(words, len(words))
    texts = [" ".join(lead + words + lead), " ".join(lead + some + lead), " ".join(lead + words[: len(words) // 3]), " ".join(shuffled), " ".join((words + lead) * 3)]
    whole, damaged, third, mixed, thrice = judged(spark, texts)
    assert template.label in whole.labels.split(",") and whole.score == 1.0
    assert template.label in damaged.labels.split(",") and 0.7 <= damaged.score <= 1.0
    assert template.label not in mixed.labels.split(",") and template.label not in third.labels.split(",")
    spans = [s for s in thrice.spans if s.label == template.label and s.coverage == 1.0 and s.end_word - s.first_word == len(words)]
    assert [s.first_word for s in spans] == [0, len(words) + 300, 2 * len(words) + 600]


def test_neighbouring_diagonals_make_one_span(spark):
    words = [f"q{i}" for i in range(60)]
    text = " ".join(words[:20] + ["new"] + words[20:40] + words[42:])
    (r,) = judged(spark, [text], templates=[Template("own", " ".join(words))])
    (span,) = r.spans
    assert (span.first_word, span.end_word) == (0, 59) and 0.9 < span.coverage < 1
    assert judged(spark, [text], templates=[Template("own", " ".join(words))], gap=0, least=0.9)[0].spans == []


def test_awkward_rows(spark):
    docs = awkward(spark).withColumnsRenamed({"n_chars": "label"}).selectExpr("*", "1 as row", "2 as gram", "3 as words")
    rows = summary(scan(docs)).collect()
    assert sorted(map(str, [(r.doc_id, r.n_words) for r in rows])) == sorted(map(str, [(d.doc_id, len(plain_words(d.text))) for d in docs.collect()]))
    assert all((r.n_base, r.first_word, r.base_labels, r.labels, r.score) == (0, None, "", "", 0.0) for r in rows)
    assert summary(scan(documents(spark, []))).collect() == []


def test_a_long_text_full_of_hits(spark):
    (r,) = judged(spark, ["mit license " * 30_000])
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (60_000, 30_000, 0, 59_998, "mit")


def test_templates():
    assert len(gram_rows(TEMPLATES)) < 1000
    with pytest.raises(ValueError):
        gram_rows([Template("one", "word")])
