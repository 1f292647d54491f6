"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

Quality classifier, near-duplicate removal, benchmark decontamination, personal data, BPE. All stages
but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candles.llm import bpe, jaccard, pii, quality, tiling
from candles.llm.common import table
from candles.session import discard, scratch, scratch_removed

ACCEPTED = 0.5
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def identity() -> Column:
    """What tells a document from others: its id (known ids first) and its text."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id"), F.xxhash64("text").alias("hash"))


def unused(docs: DataFrame, name: str) -> str:
    """`name`, made longer until no column of the documents has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are good, by the classifier trained on the labels given for training. An
    empty or null text has no bad line and stays or goes by the share of good labels; a very long one is
    scored whole. Repeated rows, null ids and other columns, whatever their names, stay as they are."""
    labels = table(spark, sf_dir, "labels").where(~quality.held_out())
    model, empty = quality.fit(docs, labels)
    aside = {c: unused(docs, "_score") for c in docs.columns if c.lower() == "score"}
    scored = quality.score(docs.withColumnsRenamed(aside), model, empty)
    kept = scored.where(F.col("score") >= ACCEPTED).drop("score")
    return kept.withColumnsRenamed({new: old for old, new in aside.items()}).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (brought together by SimHash anchors, held to a Jaccard similarity of
    at least 0.8 of five-word shingles, which also finds what anchors miss) the document with the smallest id, known ids first; one of those that equal it in id and text. Null and empty
    texts are one group."""
    key = unused(docs, "_id")
    named = docs.withColumn(key, identity())
    groups = jaccard.near_duplicates(named.select(F.col(key).alias("id"), "text"), key="id")
    kept = groups.where(F.col("id") == F.col("component_id")).select(F.col("id").alias(key)).distinct()
    return named.join(kept, key).dropDuplicates([key]).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test of the benchmark in them. Null and empty texts stay, as do repeated rows."""
    key = unused(docs, "_id")
    named = docs.withColumn(key, identity())
    found = tiling.contaminated(named.select(F.col(key).alias("id"), "text"), table(spark, sf_dir, "benchmark"), key="id")
    return named.join(found.select(F.col("id").alias(key)).distinct(), key, "left_anti").select(docs.columns)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their personal data replaced by its kind; n_chars is counted anew. Keys and
    passwords are no kind of personal data here and stay. A null text stays null."""
    cleaned = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return cleaned


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return bpe.digests(bpe.transcode(docs, TOKENIZER, packed_ids=True))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify_quality),
    ("near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", remove_personal_data),
    ("BPE encoding and decoding", tokenize),
]
#: SQL expresses neither trained models nor tokenizers; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; of what they write only the last one's result stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, name.split()[0].lower())
        with scratch_removed(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return docs
