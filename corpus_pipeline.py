"""From raw documents to packed training windows, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from histkit.llm import mixing, packing, quality, secretscan, simhash
from histkit.llm.common import store, table
from histkit.llm.queries import word_tokenizer


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.good_rows(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.without_near_duplicates(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts masked."""
    return secretscan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it whole."""
    return mixing.mixed_rows(docs)


#: Room of the word tables: workers hold them while the executors' heaps are as large as all stages made them.
WORD_ROOM = 30_000_000


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of what the mix holds."""
    return packing.pack(docs, word_tokenizer(), room=WORD_ROOM)


STAGES = [
    ("quality classifier", good),
    ("SimHash near-dedup", distinct),
    ("secret scans", without_secrets),
    ("mixing sources", mixed),
    ("packing", packed),
]

#: The stages use a trained model, 64-bit hashes and tokens, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
