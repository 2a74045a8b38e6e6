"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are words and the 4 to 6 first letters of words. The vocabulary holds the terms whose
link with the toxic label is stronger than chance would give among as many terms, so the cosine
is that of the toxic vocabulary in two texts, not of whole texts (README has figures). Labelled
examples are vectors over it, kept in an inverted index of blocks of similar examples
with each term's largest weight per block. A query bounds every block by these maxima and visits blocks by
falling bound until the bound is below the k-th best similarity: the result is exact. Similarities vote
for the neighbours' labels, and the nearest examples and shared terms are the evidence.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from histkit.llm.common import bounded_batches, store

#: Labelled rows that are learned from, and terms in the vocabulary, at most.
TRAIN_ROWS = 20_000
VOCABULARY = 4096
NEIGHBOURS = 25
BLOCK = 64
#: What the share among documents without any term counts in a vote, in neighbours of similarity 1.
PRIOR = 0.5
AROUND = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "¡¿«»“”„’‘…–—"
STEMS = (4, 5, 6)


def terms_of(text: str | None, starts: set[str] | None = None) -> Counter:
    """Counts of the text's terms; ``starts`` are the only first four letters of interest."""
    out: Counter = Counter()
    for word, n in Counter((text or "").lower().split()).items():
        word = word.strip(AROUND)
        if len(word) < 3 or starts is not None and word[:4] not in starts:
            continue
        out[word] += n
        for size in STEMS:
            if len(word) > size:
                out[word[:size] + "-"] += n
    return out


def starts_of(terms: dict[str, float]) -> set[str]:
    """First four letters of the words that the terms come from; only stems end in a mark."""
    return {(t[:-1] if t.endswith("-") else t)[:4] for t in terms}


class BlockMaxIndex:
    """Examples over a vocabulary, as unit vectors; postings by term, cut at block borders."""

    def __init__(self, terms: dict[str, float], examples: list[tuple[int, int, dict[str, int]]], base: float):
        """``terms``: inverse document frequencies. ``examples``: (id, label, counts)."""
        self.terms, self.base = terms, base
        self.starts = starts_of(terms)
        vectors = sorted(((max(v, key=lambda t: (v[t], t)), i, y, v) for i, y, c in examples if (v := self.vector(c))), key=lambda e: (e[0], e[1]))
        self.ids = [i for _, i, _, _ in vectors]
        self.labels = np.array([y for _, _, y, _ in vectors], dtype=float)
        self.blocks = -(-len(vectors) // BLOCK)
        places: dict[str, list[tuple[int, float]]] = {}
        for at, (_, _, _, v) in enumerate(vectors):
            for t, w in v.items():
                places.setdefault(t, []).append((at, w))
        self.postings, self.most = {}, {}
        for t, entries in places.items():
            at, w = np.array([e[0] for e in entries]), np.array([e[1] for e in entries])
            self.postings[t] = at, w, np.searchsorted(at, np.arange(self.blocks + 1) * BLOCK)
            most = np.zeros(self.blocks)
            np.maximum.at(most, at // BLOCK, w)
            self.most[t] = most

    def vector(self, counts: dict[str, int]) -> dict[str, float]:
        v = {t: (1 + math.log(n)) * self.terms[t] for t, n in counts.items() if t in self.terms}
        norm = math.sqrt(math.fsum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()}

    def nearest(self, query: dict[str, float], k: int) -> list[tuple[float, int]]:
        """(similarity, -place) of the k most similar examples, ties to the first."""
        known = [(w, t) for t, w in query.items() if t in self.postings]
        if not known:
            return []
        bound = sum(w * self.most[t] for w, t in known)
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == k and bound[b] + 1e-12 < best[0][0]:
                break
            score = np.zeros(BLOCK)
            for w, t in known:
                at, weights, cut = self.postings[t]
                if cut[b] < cut[b + 1]:
                    score[at[cut[b] : cut[b + 1]] - b * BLOCK] += w * weights[cut[b] : cut[b + 1]]
            for x in np.flatnonzero(score):
                entry = (float(score[x]), -int(b * BLOCK + x))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return sorted(best, reverse=True)

    def judge(self, text: str | None, k: int = NEIGHBOURS) -> tuple[float, str, str]:
        """Score, ids of the nearest examples, and the terms that were found."""
        query = self.vector(terms_of(text, self.starts))
        near = self.nearest(query, k)
        votes = sum(s * self.labels[-at] for s, at in near)
        score = (votes + PRIOR * self.base) / (sum(s for s, _ in near) + PRIOR)
        return float(score), ",".join(str(self.ids[-at]) for _, at in near[:3]), " ".join(sorted(query, key=lambda t: (-query[t], t))[:8])


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: Share of common shingles from which a row counts as a near copy of its group's first row.
NEAR = 0.8


@F.pandas_udf(T.ArrayType(T.LongType()))
def _shingles(texts: pd.Series) -> pd.Series:
    """Hashes of the 4-word shingles, the least first."""
    import xxhash

    def hashes(text: str | None) -> list[int]:
        words = (text or "").lower().split()
        return sorted({xxhash.xxh64_intdigest(" ".join(words[i : i + 4])) >> 1 for i in range(max(1, len(words) - 3))})

    return texts.map(hashes)


def without_near_copies(text: DataFrame) -> DataFrame:
    """``text`` (doc_id, text, toxic) without the rows whose shingles are mostly those of the first
    row with their least hash and label. The hash, which near copies mostly share, only finds the pairs."""
    group = Window.partitionBy("sketch", "toxic").orderBy("doc_id", "text")
    sketched = text.withColumn("shingles", _shingles("text")).withColumn("sketch", F.col("shingles")[0])
    paired = sketched.withColumns({"nth": F.row_number().over(group), "first": F.first("shingles").over(group)})
    both = F.size(F.array_intersect("shingles", "first"))
    near = both >= NEAR * (F.size("shingles") + F.size("first") - both)
    return paired.where((F.col("nth") == 1) | ~near).select("doc_id", "text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> BlockMaxIndex:
    """The index over at most ``train_rows`` labelled rows that are not held out, the first in
    hash order of their ids; of near copies one is used."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select(F.col("doc_id").alias("labelled"), "toxic")
    text = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    sample = store(without_near_copies(text.select("doc_id", "text", "toxic")), "labelled")
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic].update(terms_of(text).keys())
            both = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(both, pa.string()), pa.array([seen[0][t] for t in both], pa.int64()), pa.array([seen[1][t] for t in both], pa.int64())], names=["term", "clean", "toxic"])

    counts = store(sample.select("text", "toxic").mapInArrow(count_terms, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "terms")
    terms = {}
    if n0 and n1:
        total, rate = counts.count(), n1 / (n0 + n1)
        has = F.col("clean") + F.col("toxic")
        part = lambda k, n, p: F.when(k > 0, k * F.log(k / (n * F.lit(p)))).otherwise(0.0)
        strength = 2 * (part(F.col("toxic"), has, rate) + part(F.col("clean"), has, 1 - rate))
        strong = counts.withColumn("strength", strength).where((F.col("strength") > 2 * math.log(total)) & (F.col("toxic") / has > 0.5))
        for r in strong.orderBy(F.desc("strength"), "term").limit(VOCABULARY).collect():
            terms[r.term] = math.log((1 + n0 + n1) / (1 + r.clean + r.toxic)) + 1
    starts = starts_of(terms)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, y, [t for t in c if t in terms], [c[t] for t in c if t in terms]) for i, y, c in ((i, y, terms_of(text, starts)) for i, text, y in zip(*(c.to_pylist() for c in batch.columns)))]
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["doc_id", "toxic", "terms", "counts"])

    found = sample.select(F.col("doc_id").cast("long"), "text", "toxic").mapInArrow(vectors, "doc_id long, toxic int, terms array<string>, counts array<long>").collect()
    examples = [(r.doc_id, r.toxic, dict(zip(r.terms, r.counts))) for r in sorted(found, key=lambda r: r.doc_id)]
    without = [y for _, y, c in examples if not c]
    return BlockMaxIndex(terms, examples, (sum(without) + 0.1) / (len(without) + 1))


VERDICT = T.StructType().add("score", "double").add("nearest", "string").add("terms", "string")


def judge(docs: DataFrame, labels: DataFrame, least: float = 0.7, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, nearest (example ids) and terms of each row.

    Only the text is scored. A null or empty text has no terms and gets the share of toxic
    examples without terms; a null doc_id is not held out; repeated rows score alike; without
    labels of both kinds every text gets that prior.
    """
    bounded_batches(docs)
    index = learn(docs, labels, train_rows)  # bounded by train_rows and VOCABULARY

    @F.pandas_udf(VERDICT)
    def verdicts(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([index.judge(t) for t in texts], columns=VERDICT.names)

    scored = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), verdicts("text").alias("v"))
    return scored.select("doc_id", "held_out", "v.score", (F.col("v.score") >= least).cast("int").alias("predicted"), "v.nearest", "v.terms")
