"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    full = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed: int, n: int, words: int = 200) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(n))


def awkward(spark):
    """Rows with nulls in every column, empty and long texts, ties and a row that is there twice."""
    base = [(i, prose(i, 20 + i * 7), "en", f"s{i % 3}") for i in range(12)]
    odd = [
        (20, None, None, None),
        (21, "", "en", "s0"),
        (22, " \t\n ", "en", "s0"),
        (None, prose(1, 50), "en", "s1"),
        (None, None, "en", None),
        (23, base[3][1], "en", "s0"),
        (23, base[3][1], "en", "s0"),
        (24, "word " * 30_000, "de", "s1"),
        (25, "Ärger mit – Zeichen und 日本語 💡", "de", "ŝ"),
        (26, "one", "en", "s2"),
    ]
    return documents(spark, base + odd)


def rows_of(df, *names):
    return [tuple(r[n] for n in names) for r in df.select(*names).collect()]
