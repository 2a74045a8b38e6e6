"""Quality classifier with hierarchical empirical Bayes over sites.

Evidence: a logistic model over binned shape features of the whole text (how it repeats, which
characters it uses, how long its words are), fitted to a bounded sample of labelled rows. Every document's
evidence is summed per path and host; the share of good documents of a host is shrunk toward
the global share and that of a path toward its host's, each with the strength that the
spread between sites implies. A document's posterior is its evidence moved by the odds of its path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.llm.common import bounded_batches, fresh, store

#: Labelled rows that the evidence model is fitted to, at most.
TRAIN_ROWS = 20_000
BINS = 12
RIDGE = 1.0
FEATURES = ("log_words", "word_length", "distinct", "upper", "marks", "digits", "shouts", "bars", "repeats", "line_repeats", "letters")

_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGITS = bytes(range(48, 58))
_MARKS = b"#$%&*+/<=>@[\\]^_`{|}~"


def features(text: str | None) -> tuple[float, ...]:
    raw = (text or "").encode()
    words = raw.split()
    n, m = max(1, len(raw)), max(1, len(words))
    lines = raw.split(b"\n")
    count = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    repeats = sum(map(bytes.__eq__, words, words[1:])) / m
    return (
        float(np.log1p(len(words))), (len(raw) - len(lines)) / m, len(set(words)) / m, count(_UPPER), count(_MARKS), count(_DIGITS),
        raw.count(b"!") / m, raw.count(b"|") / m, repeats, 1 - len(set(lines)) / len(lines), count(_LETTERS),
    )


@dataclass(frozen=True)
class Evidence:
    """Bin edges per feature, a weight per bin, and the intercept."""

    edges: list[np.ndarray]
    weights: np.ndarray
    base: float

    def one_hot(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros((len(values), len(self.weights)))
        at = 0
        for k, edges in enumerate(self.edges):
            out[np.arange(len(values)), at + np.searchsorted(edges, values[:, k], "right")] = 1
            at += len(edges) + 1
        return out

    def logit(self, values: np.ndarray) -> np.ndarray:
        total, at = np.full(len(values), self.base), 0
        for k, edges in enumerate(self.edges):
            total += self.weights[at + np.searchsorted(edges, values[:, k], "right")]
            at += len(edges) + 1
        return total


def fit(values: np.ndarray, good: np.ndarray, rounds: int = 30) -> Evidence:
    """Ridge logistic regression on one-hot bins by Newton steps. Without both labels there is no evidence."""
    if not len(good) or good.min() == good.max():
        return Evidence([np.zeros(0)] * len(FEATURES), np.zeros(len(FEATURES)), 0.0)
    edges = [np.unique(np.quantile(values[:, k], np.arange(1, BINS) / BINS)) for k in range(values.shape[1])]
    start = Evidence(edges, np.zeros(sum(len(e) + 1 for e in edges)), 0.0)
    x = np.column_stack([start.one_hot(values), np.ones(len(good))])
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (good - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Evidence(edges, w[:-1], float(w[-1]))


_VALUES = T.ArrayType(T.DoubleType())


@F.pandas_udf(_VALUES)
def feature_values(texts: pd.Series) -> pd.Series:
    return texts.map(features)


def evidence_model(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Evidence:
    """Fit on at most ``train_rows`` labelled documents, the first in hash order of their ids."""
    label = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("good"))
    chosen = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select(F.col("doc_id").alias("labelled"), "good")
    text = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    rows = text.select("doc_id", feature_values("text").alias("x"), "good").limit(2 * train_rows).collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))
    return fit(np.array([r.x for r in rows]).reshape(-1, len(FEATURES)), np.array([float(r.good >= 0.5) for r in rows]))


def _strength(sites: DataFrame, mean: Column, prior: Column) -> float:
    """Rows that a prior is worth, from the spread of the sites' means around it."""
    s = sites.select("n", ((mean - prior) ** 2 * F.col("n")).alias("spread"), (prior * (1 - prior)).alias("noise"))
    r = s.agg(F.count("*").alias("sites"), F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("n").cast("double")).alias("squares"), F.sum("spread").alias("spread"), F.sum(F.col("noise") * F.col("n")).alias("noise")).first()
    if not r.rows or r.sites < 2:
        return 100.0
    noise, open_ = r.noise / r.rows, 1 - r.squares / r.rows**2
    between = max((r.spread / r.rows - (r.sites - 1) / r.rows * noise) / max(open_, 1e-9), 1e-6)
    return max(1.0, noise / between - 1)


def site_odds(evidence: DataFrame) -> DataFrame:
    """(host, path, shift): what a path's posterior adds to the log-odds, from rows (host, path, p)."""
    paths = store(evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    share = (total.good + 0.5) / (total.n + 1) if total.n else 0.5
    bounded = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    k_host = _strength(hosts, F.col("good") / F.col("n"), F.lit(share))
    hosts = hosts.select(F.col("host").alias("of_host"), bounded((F.col("good") + k_host * share) / (F.col("n") + k_host)).alias("prior"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
    k_path = _strength(both, F.col("good") / F.col("n"), F.col("prior"))
    posterior = bounded((F.col("good") + k_path * F.col("prior")) / (F.col("n") + k_path))
    shift = F.log(posterior / (1 - posterior)) - float(np.log(share / (1 - share)))
    return store(both.select("host", "path", shift.alias("shift")), "site-odds")


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", least: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with quality (posterior that the document is good) and kept (quality >= least).

    ``docs`` has doc_id, text and the two site columns; ``labels`` has doc_id and quality (0, 1).
    Nulls are site values like others; a null text is empty; repeated rows are judged alike;
    without labels of both kinds the evidence is even and all is kept. Columns named quality or
    kept are replaced.
    """
    bounded_batches(docs)
    model = evidence_model(docs, labels, train_rows)  # a few hundred numbers, sent with the task

    @F.pandas_udf(T.DoubleType())
    def logit(texts: pd.Series) -> pd.Series:
        values = np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))
        return pd.Series(model.logit(values))

    p = 1 / (1 + F.exp(-logit("text")))
    sites = site_odds(docs.select(F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"), p.alias("p")))
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("quality", "kept")])
    own, of_host, of_path, shift = fresh(docs, "own_logit", "site_host", "site_path", "site_shift")
    sites = sites.select(F.col("host").alias(of_host), F.col("path").alias(of_path), F.col("shift").alias(shift))
    scored = docs.withColumn(own, logit("text"))
    joined = scored.join(sites, F.col(host).cast("string").eqNullSafe(F.col(of_host)) & F.col(path).cast("string").eqNullSafe(F.col(of_path)), "left")
    quality = 1 / (1 + F.exp(-(F.col(own) + F.coalesce(F.col(shift), F.lit(0.0)))))
    return joined.select(*docs.columns, quality.alias("quality")).withColumn("kept", F.col("quality") >= least)


def good_rows(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns only."""
    held = [c for c in docs.columns if c.lower() in ("quality", "kept")]
    plain = docs.withColumnsRenamed({c: f"held_{i}" for i, c in enumerate(held)}) if held else docs
    out = classify(plain, labels, **options).where("kept").drop("quality", "kept")
    return out.withColumnsRenamed({f"held_{i}": c for i, c in enumerate(held)}) if held else out
