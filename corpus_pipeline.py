"""A corpus pipeline of five of the training-data operators; each stage reads what the one before it wrote.

Documents that the quality classifier rejects go; repeated chunks of lines go; one document of each near-duplicate
class stays; sources are mixed to their target weights, documents of small ones several times; the rest is encoded.

Defined cases: a null text counts as empty in every stage, and comes out as it went in; rows without an id are rows like
others, after all those with one; rows that repeat are one document to the near-duplicate stage, which keeps one of them;
very long texts go through whole; no rows give no rows; other columns go along untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, line_dedup, minhash_dedup, mixing, quality
from tallyloom.llm.common import cut
from tallyloom.session import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.decode_documents(bpe.encode_documents(docs))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("minhash_dedup", near_deduplication),
    ("mixing", source_mixing),
    ("bpe", bpe_encoding),
]

#: The classifier, the sketches and the tokeniser can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir; every stage but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
