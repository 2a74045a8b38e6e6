"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints fall into cells by the population counts of their two halves. Two
fingerprints within the radius lie in cells whose counts differ by at most the radius in sum,
so only those pairs of tiles (cells, cut where large) are brought together, each tile as one
packed array. Inside a pair, blocks sorted by the counts of the quarters are skipped by the same bound
and the others compared with exclusive-or and bit counts. A pair of tiles gives a spanning
forest of its links, never all pairs of a dense group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from histkit.llm.common import bounded_batches, fresh, store
from histkit.llm.graph import components, local_components

SEED = 42
#: Fingerprints in a tile at most, on average; those of a cell beyond it are dealt to several tiles.
TILE = 32_768
BLOCK = 1024
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16
#: Links of one pair of tiles before they are reduced to a forest.
MANY_LINKS = 1 << 20


def fingerprint(text: str | None, words: int = 4) -> int:
    """64 bits, unsigned: a bit is 1 if it is set in over half of the shingles' hashes."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*[tokens[k:] for k in range(words)])))
    n, ones = len(shingles), np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[start : start + CHUNK]], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(fps).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def near_in_tiles(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of two arrays of distinct fingerprints, as a spanning forest."""

    def blocks(fps: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        q = _quarters(fps)
        order = np.lexsort(q.T)
        fps, q = fps[order], q[order]
        return fps, [(q[s : s + BLOCK].min(0), q[s : s + BLOCK].max(0)) for s in range(0, len(fps), BLOCK)]

    a, a_bounds = blocks(a)
    b, b_bounds = (a, a_bounds) if same else blocks(b)
    shift = 0 if same else len(a)
    nodes = a if same else np.concatenate([a, b])
    left, right, found = [], [], 0
    for x, (low, high) in enumerate(a_bounds):
        for y, (low2, high2) in enumerate(b_bounds):
            if same and y < x or np.maximum(0, np.maximum(low - high2, low2 - high)).sum() > radius:
                continue
            differing = np.bitwise_count(a[x * BLOCK : (x + 1) * BLOCK, None] ^ b[None, y * BLOCK : (y + 1) * BLOCK])
            i, j = np.nonzero(differing <= radius)
            i, j = i + x * BLOCK, j + y * BLOCK + shift
            keep = i != j
            left.append(i[keep])
            right.append(j[keep])
            found += len(left[-1])
            if found > MANY_LINKS:
                root = local_components(np.concatenate(left), np.concatenate(right), len(nodes))
                left, right = [np.nonzero(root != np.arange(len(root)))[0]], [root[root != np.arange(len(root))]]
                found = len(left[0])
    if not found:
        return nodes[:0], nodes[:0]
    root = local_components(np.concatenate(left), np.concatenate(right), len(nodes))
    other = root != np.arange(len(root))
    return nodes[other], nodes[root[other]]


def near_links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) of distinct fingerprints (column fp): every group that links connect is
    connected by them."""
    halves = [F.bit_count(F.col("fp").bitwiseAND(0xFFFFFFFF)), F.bit_count(F.shiftrightunsigned("fp", 32))]
    in_cells = distinct.select("fp", *[h.alias(f"h{k}") for k, h in enumerate(halves)])
    # At most 33 * 33 cells, whatever the input's size.
    cells = store(in_cells.groupBy("h0", "h1").agg(F.ceil(F.count("*") / TILE).cast("int").alias("chunks")), "cells")
    tile = lambda h0, h1, chunk: ((F.col(h0) * 33 + F.col(h1)).cast("long") * (1 << 32) + F.col(chunk)).cast("long")
    dealt = in_cells.join(F.broadcast(cells), ["h0", "h1"]).withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("long"))
    tiles = store(dealt.groupBy(tile("h0", "h1", "chunk").alias("tile")).agg(F.collect_list("fp").alias("fps")), "tiles")
    shifts = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) if abs(x) + abs(y) <= radius]
    moved = cells.withColumn("shift", F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in shifts])))
    moved = moved.select("h0", "h1", "chunks", (F.col("h0") + F.col("shift.x")).alias("g0"), (F.col("h1") + F.col("shift.y")).alias("g1"))
    others = cells.select(F.col("h0").alias("g0"), F.col("h1").alias("g1"), F.col("chunks").alias("chunks2"))
    of_cells = moved.join(F.broadcast(others), ["g0", "g1"]).where("h0 * 33 + h1 <= g0 * 33 + g1")
    chunked = of_cells.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("d", F.explode(F.sequence(F.lit(0), F.col("chunks2") - 1)))
    pairs = chunked.select(tile("h0", "h1", "c").alias("x"), tile("g0", "g1", "d").alias("y")).where("x <= y")
    left = tiles.select(F.col("tile").alias("x"), F.col("fps").alias("x_fps"))
    right = tiles.select(F.col("tile").alias("y"), F.col("fps").alias("y_fps"))
    together = pairs.join(left, "x").join(right, "y").select((F.col("x") == F.col("y")).alias("same"), "x_fps", "y_fps")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                a, b = (batch.column(c)[k].values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in (1, 2))
                out.append(near_in_tiles(a, b, batch.column(0)[k].as_py(), radius))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in zip(*out)], names=["a", "b"])

    return together.mapInArrow(compare, "a long, b long")


def simhash_groups(docs: DataFrame, radius: int = 4) -> DataFrame:
    """(doc_id, digest, fp, first) for each row of ``docs`` (doc_id, text); ``digest`` is a hash
    of the text, ``first`` the group's smallest (no_id, doc_id, digest).

    Null and empty texts have fingerprint 0 and form a group with all fingerprints near it.
    A null doc_id comes last in its group. Repeated rows each give a row.
    """
    bounded_batches(docs)
    rows = store(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), fingerprints("text").alias("fp")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    distinct = store(rows.groupBy("fp").agg(F.min(order).alias("first")), "distinct-fingerprints")
    roots = components(near_links(distinct, radius))
    linked = distinct.join(roots, F.col("fp") == F.col("node")).select("fp", "root", "first")
    firsts = linked.groupBy("root").agg(F.min("first").alias("of_group"))
    linked = linked.select(F.col("fp").alias("near"), "root").join(firsts, "root")
    groups = distinct.join(linked, F.col("fp") == F.col("near"), "left").select(F.col("fp").alias("key"), F.coalesce("of_group", "first").alias("first"))
    return rows.join(groups, F.col("fp") == F.col("key")).select("doc_id", "digest", "fp", "first")


def near_duplicates(docs: DataFrame, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint and component_id (smallest doc_id reachable) of each row."""
    return simhash_groups(docs, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def without_near_duplicates(docs: DataFrame, radius: int = 4) -> DataFrame:
    """The first row of each group, with all columns; of fully repeated rows one stays."""
    first = simhash_groups(docs, radius).select("first.doc_id", "first.digest").distinct()
    keep, text_key, nth = fresh(docs, "kept_id", "kept_text", "nth")
    first = first.select(F.col("doc_id").alias(keep), F.col("digest").alias(text_key))
    found = docs.join(first, F.col("doc_id").cast("long").eqNullSafe(F.col(keep)) & (F.xxhash64("text") == F.col(text_key)))
    one = F.row_number().over(Window.partitionBy(keep, text_key).orderBy(keep))
    return found.withColumn(nth, one).where(F.col(nth) == 1).select(*docs.columns)
