"""The registered queries of this package, one per operator.

What becomes of nulls, empty and very long texts, ties, repeated rows, empty tables and other columns is said
where the operator is: every query runs it over its whole table, columns it does not name are not read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candles.llm import bpe, embeddings, lexical, periodic, pii, quality, sharding, simhash, tiling, token_orc, topk, url_filter, warc
from candles.llm.common import table
from candles.session import scratch

#: The rules that the URL query judges by.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]
SHARDS, END_ID = 16, 2
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and group of every document; groups are linked by at most two differing bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_token_orc(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, written as ORC in ascending order of ids and read back."""
    path = scratch(spark, "token-orc")
    token_orc.write_tokens(table(spark, folder, "documents"), path, TOKENIZER, END_ID)
    return token_orc.digests(token_orc.read_tokens(spark, path))


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    return bpe.digests(bpe.transcode(table(spark, folder, "documents"), TOKENIZER, packed_ids=True))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """A record of every page, written as WARC archives and read back."""
    path = scratch(spark, "warc")
    warc.write_warc(table(spark, folder, "pages"), path)
    return warc.read_warc(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Links and group of every vector by cosine."""
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The rule and the verdict for every page."""
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return url_filter.judge(table(spark, folder, "pages"), rules)


def op7_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document, by a model fitted without the held-out labels."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model, empty = quality.fit(docs, labels.where(~quality.held_out()))
    scored = quality.score(docs.select("doc_id", "text"), model, empty)
    return scored.select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_jump_hash(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document, and its shard if there were one more."""
    return sharding.shard(table(spark, folder, "documents"), SHARDS)


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the tests of the benchmark that they contain."""
    return tiling.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, counted and as spans."""
    return pii.digests(pii.detect(table(spark, folder, "documents").select("doc_id", "text")))


def op11_uniform_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """The five vectors with the highest integer inner products for every fiftieth vector."""
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_blocked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty documents with the highest scores for every item of the benchmark."""
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeated words in every document, a tenth of which repeat themselves by a rule."""
    docs = periodic.with_repeats(table(spark, folder, "documents"))
    return periodic.digests(periodic.periodic_runs(docs))


QUERIES = {
    f.__name__: f for f in (op1_simhash, op2_token_orc, op3_bpe, op4_warc, op5_collisions, op6_url_filter, op7_line_quality,
                           op8_jump_hash, op9_decontamination, op10_pii,
                           op11_uniform_threshold, op12_blocked_search, op13_periodic_runs)
}
