"""Exact top-k by inner product over an impact-ordered, score-at-a-time index.

Rows are dealt into blocks; in each block a posting is (dimension, value, row), and postings
with the same dimension and quantised value form a segment. A query takes the segments in descending order of
the size of what they add to a score, in batches. After a batch a row's score is known
up to what its open postings can add (each at most the batch's least impact) and the rounding
of the values (at most |query| * |rounding error of the row|). Rows that may still be among
the k best are the possible members; when they are few, or all segments are done, they are rescored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histkit.llm.common import bounded_batches, store

ROWS = 16_384
QUERIES = 1024
LEVELS = 128
#: Shares of the postings after which a proof is tried.
BATCHES = (0.5, 0.65, 0.75, 0.85, 0.93, 1.0)
#: Possible members that are rescored at once instead of opening more segments.
FEW = 256


class ImpactIndex:
    def __init__(self, values: np.ndarray, uids: np.ndarray, ids: np.ndarray):
        self.values, self.uids, self.ids = values, uids, ids
        n, dims = values.shape
        step = max(1, -(-int(np.ptp(values)) // LEVELS)) if values.size else 1
        level = np.floor_divide(values, step)
        impact = level * step + (step - 1) / 2
        self.error = np.sqrt(((values - impact) ** 2).sum(axis=1))
        low = int(level.min()) if values.size else 0
        span = int(level.max()) - low + 1 if values.size else 1
        flat = (np.arange(dims)[None, :] * span + (level - low)).ravel()  # segment of each posting
        order = np.argsort(flat, kind="stable")
        self.rows = (order // max(dims, 1)).astype(np.int32)
        segment, self.start, self.size = np.unique(flat[order], return_index=True, return_counts=True)
        self.dim = segment // span
        self.impact = (segment % span + low) * step + (step - 1) / 2

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best rows but the query's own, ties to the smaller id."""
        n, dims = self.values.shape
        adds = query[self.dim] * self.impact
        order = np.argsort(-np.abs(adds), kind="stable")
        done = np.cumsum(self.size[order])
        cuts = np.searchsorted(done, np.array(BATCHES) * n * dims, "left") + 1
        score, opened = np.zeros(n), np.zeros(n)
        rounding = np.sqrt((query * query).sum()) * self.error
        valid = self.uids != own
        k = min(k, int(valid.sum()))
        if not k:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begin = 0
        for cut in cuts:
            batch = order[begin:cut]
            begin = max(begin, cut)
            if len(batch):
                size = self.size[batch]
                posting = np.repeat(self.start[batch] - np.cumsum(size) + size, size) + np.arange(size.sum())
                rows = self.rows[posting]
                score += np.bincount(rows, np.repeat(adds[batch], size), n)
                opened += np.bincount(rows, minlength=n)
            rest = np.abs(adds[order[cut]]) if cut < len(order) else 0.0
            slack = rounding + rest * (dims - opened) + 1e-6
            floor = np.partition((score - slack)[valid], -k)[-k]
            possible = np.flatnonzero(valid & (score + slack >= floor))
            if len(possible) <= FEW or cut >= len(order):
                break
        exact = self.values[possible] @ query
        top = np.lexsort((self.ids[possible], -exact))[:k]
        return possible[top], exact[top]


def top_k(vectors: DataFrame, queries, k: int = 5, scale: int = 256, rows: int = ROWS, per_block: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best rows.

    ``vectors`` has vec_id and embedding; ``queries`` is a condition on its columns that picks the queries. Components
    become floor(scale * x); scores must fit a long. Vectors that are null, or hold null or
    non-finite components, take no part. A row is not a candidate of itself, but repeated rows are
    of each other. Vectors of different lengths do not meet. With fewer than k candidates all are returned.
    """
    bounded_batches(vectors)
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    ids = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long"), F.coalesce(queries, F.lit(False)).alias("asks"), "embedding")
    ids = store(ids.where(finite).select("uid", "vec_id", "asks", whole.alias("v"), F.size("embedding").alias("dims")), "quantities")
    sizes = ids.groupBy("dims").agg(F.ceil(F.count("*") / rows).cast("long").alias("blocks"), F.ceil(F.count_if("asks") / per_block).cast("long").alias("asking"))

    def gather(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("uid").combine_chunks()
        columns = {name: [group.column(name).to_numpy().astype(np.int64).tobytes()] for name in ("uid", "vec_id")}
        values = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.table({"dims": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()]), **columns, "v": [values.tobytes()]})

    def blocks(of: DataFrame, n: str) -> DataFrame:
        dealt = of.join(sizes, "dims").withColumn("block", F.pmod(F.xxhash64("uid"), F.col(n)))
        known = dealt.select("dims", "block", "uid", F.coalesce("vec_id", F.lit(-(1 << 63))).alias("vec_id"), "v")
        return store(known.groupBy("dims", "block").applyInArrow(gather, "dims int, block long, uid binary, vec_id binary, v binary"), "vector-blocks")

    index, asked = blocks(ids, "blocks"), blocks(ids.where("asks"), "asking")
    asked = asked.select("dims", *[F.col(c).alias(f"q_{c}") for c in ("block", "uid", "vec_id", "v")])
    # The blocks of queries against the blocks of rows: each pair is one row.
    pairs = index.join(asked, "dims").select("dims", "block", "uid", "vec_id", "v", "q_uid", "q_vec_id", "q_v")
    pairs = pairs.repartition(F.col("dims"), F.col("block"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, at = None, None
        for batch in batches:
            for row in batch.to_pylist():
                dims = row["dims"]
                if (dims, row["block"]) != name:
                    name = dims, row["block"]
                    uids, vec_ids = (np.frombuffer(row[c], np.int64) for c in ("uid", "vec_id"))
                    at = ImpactIndex(np.frombuffer(row["v"], np.int64).reshape(len(uids), dims), uids, vec_ids)
                q_uids, q_ids = (np.frombuffer(row[c], np.int64) for c in ("q_uid", "q_vec_id"))
                out = []
                for uid, query_id, query in zip(q_uids, q_ids, np.frombuffer(row["q_v"], np.int64).reshape(len(q_uids), dims)):
                    found, scores = at.best(query, uid, k)
                    out.append((np.full(len(found), uid), np.full(len(found), query_id), at.ids[found], scores))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["uid", "query_id", "vec_id", "score"])

    best = pairs.mapInArrow(search, "uid long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id"))
    null_id = lambda c: F.nullif(F.col(c), F.lit(-(1 << 63))).alias(c)
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(null_id("query_id"), "rank", null_id("vec_id"), "score")
