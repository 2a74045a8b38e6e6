"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.llm.common import bounded_batches

# Patterns of the contract (fixed values): leftmost, non-overlapping per kind.
ASSIGN = re.compile(
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_MARKS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# A run that is too short holds no match that is long enough, so the least length may stand in the pattern.
ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
HEX = re.compile("[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = re.compile("[A-Za-z0-9+/_=-]{20,}")
#: Least bits per character in a window, by the characters of the candidate. Of random strings of 24 and 40 letters
#: 10% and 1% have no window with 3.88; long compounds and names in camel case have 3.82 at most.
LEAST_BITS = {"hex": 3.1, "mixed": 3.8, "letters": 3.88}
ALLOWED = re.compile(
    "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"  # a UUID
    "|[A-Za-z]+([-_/][A-Za-z]+)+"  # words joined by marks
    "|[0-9_/=+-]+"  # numbers and rules
)
PLACEHOLDER = re.compile("example|placeholder|redacted|dummy|changeme|xxxxx|0123456789|1234567890|abcdefghij", re.I | re.A)
#: What a placeholder word makes harmless: the characters around it up to a mark.
PIECE = re.compile("[A-Za-z0-9]+")
WORDS = re.compile("[A-Za-z]+([-_/+=]+[A-Za-z]+)*")
MARKS = "/+=_-"
_TERMS = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def character_class(candidate: str) -> str:
    if re.fullmatch("[0-9a-fA-F]+", candidate):
        return "hex"
    return "mixed" if re.search("[0-9]", candidate) and re.search("[A-Za-z]", candidate) else "letters"


def dense_windows(candidate: str, least: float) -> Iterator[tuple[int, int]]:
    """Merged spans of the windows whose entropy is at least ``least``.

    With counts c in a window of w characters the entropy is log2(w) - sum(c log2 c) / w;
    a step changes two counts and so two terms of the sum.
    """
    counts: dict[str, int] = {}
    total, begun, end = 0.0, -1, -1
    for k, char in enumerate(candidate):
        c = counts.get(char, 0)
        total += _TERMS[c + 1] - _TERMS[c]
        counts[char] = c + 1
        if k >= WINDOW:
            gone = candidate[k - WINDOW]
            c = counts[gone]
            total += _TERMS[c - 1] - _TERMS[c]
            counts[gone] = c - 1
        if k >= WINDOW - 1 and math.log2(WINDOW) - total / WINDOW >= least - 1e-9:
            start = k - WINDOW + 1
            if begun >= 0 and start > end:
                yield begun, end
                begun = -1
            begun, end = (start if begun < 0 else begun), k + 1
    if begun >= 0:
        yield begun, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start, then kind."""
    found = []
    lower = text.lower()
    if any(mark in lower for mark in ASSIGN_MARKS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> Iterator[tuple[int, str]]:
    """(start, string) of what may be a key: runs without their pieces that hold a placeholder word."""
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if ALLOWED.fullmatch(run):
            continue
        if not PLACEHOLDER.search(run):
            yield m.start(), run
            continue
        at = 0
        for start, end in [(p.start(), p.end()) for p in PIECE.finditer(run) if PLACEHOLDER.search(p.group())] + [(len(run), len(run))]:
            rest = run[at:start]
            if len(rest) >= WINDOW and not ALLOWED.fullmatch(rest.strip(MARKS)):
                yield m.start() + at, rest
            at = end


def outside(start: int, end: int, base: list[tuple[int, int, int]], reach: list[int]) -> Iterator[tuple[int, int]]:
    """The parts of start..end that no base span covers. ``reach``: the farthest end of the base spans up to each."""
    for k in range(bisect_right(reach, start), len(base)):
        s, _, e = base[k]
        if s >= end:
            break
        if s > start:
            yield start, s
        start = max(start, e)
    if start < end:
        yield start, end


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of dense windows in candidates, less what base spans cover.

    Of a span that a base span cuts, a part that is words joined by marks (a key's name, say) only
    counts if it is one word that is dense by itself.
    """
    found, reach = [], list(accumulate((e for _, _, e in base), max))
    for at, candidate in candidates(text):
        for start, end in dense_windows(candidate, LEAST_BITS[character_class(candidate)]):
            for s, e in outside(start + at, end + at, base, reach):
                if e - s < end - start:
                    part = text[s:e].strip(MARKS)
                    s = text.index(part, s)
                    e = s + len(part)
                    if not part or WORDS.fullmatch(part) and (ALLOWED.fullmatch(part) or not any(dense_windows(part, LEAST_BITS["letters"]))):
                        continue
                found.append((s, 3, e))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SPANS = T.StructType().add("n_assign", "long").add("n_access", "long").add("n_hex", "long").add("base_sha256", "string").add("spans", "string").add("n_entropy", "long")


@F.pandas_udf(SPANS)
def secrets_of(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        text = text or ""
        base = base_spans(text)
        more = entropy_spans(text, base)
        kinds = [k for _, k, _ in base]
        digest = hashlib.sha256(joined(base).encode()).hexdigest()
        rows.append((kinds.count(0), kinds.count(1), kinds.count(2), digest, joined(sorted(base + more)), len(more)))
    return pd.DataFrame(rows, columns=SPANS.names)


def redacted(text: str, mask: str = "[SECRET]") -> str:
    base = base_spans(text)
    out, at = [], 0
    for start, _, end in sorted(base + entropy_spans(text, base)):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


@F.pandas_udf(T.StringType())
def without_secrets(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else redacted(t))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_sha256, spans and n_entropy.

    Row by row: nothing is shuffled. A null or empty text has no spans, a repeated row is scanned
    again, an empty table gives no rows. Columns of these names are replaced.
    """
    bounded_batches(docs)
    kept = [c for c in docs.columns if c.lower() not in SPANS.names]
    return docs.select(*kept, secrets_of(text).alias("secrets_found")).select(*kept, *[F.col("secrets_found")[n].alias(n) for n in SPANS.names])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span masked; n_chars, where there is one, follows the text. A null text stays
    null, repeated rows and an empty table stay as they are."""
    bounded_batches(docs)
    out = docs.withColumn("text", without_secrets("text"))
    if "n_chars" in docs.columns:
        n: Column = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
        out = out.withColumn("n_chars", n)
    return out
