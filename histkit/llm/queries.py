"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histkit.llm import centroids, centroids_sql, covertree, htmltext, licenses, licenses_sql, mixing, packing, phrases, phrases_sql, quality, secretscan, sharding, simhash, topk, toxicity
from histkit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


@query
def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "copies", "extra")


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_embeddings(table(spark, sf_dir, "embeddings"))


@query
def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard(table(spark, sf_dir, "documents"))
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return quality.classify(docs, table(spark, sf_dir, "labels")).drop("text")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.collocations(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.col(c).cast("long") for c in ("rank", "a", "l", "r", "n", "score")})


ORACLES["op11_collocations"] = phrases_sql.oracle()


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


ORACLES["op12_centroids"] = centroids_sql.oracle()


@query
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents"))).drop("spans")


ORACLES["op13_licenses"] = licenses_sql.oracle()
