"""From raw documents to token ids: quality rules, near duplicates, decontamination, secrets, encoding.

Each stage is (spark, docs, sf_dir) -> DataFrame; what it returns is written as Parquet and is the next one's ``docs``. All but
the last return the columns of ``docs``. Nulls, empty and repeated rows are treated as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from returnsmith.llm import bpe, decontaminate, jaccard_join, quality_rules, secret_scan
from returnsmith.session import settle, tune

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Learnt cutoffs and byte-pair merges have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the rules learnt from ``labels`` reject go."""
    return quality_rules.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return jaccard_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more stands in benchmark passages go."""
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark, and ``n_chars`` follows the text."""
    return secret_scan.clean(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives the text's bytes again."""
    ranks, pattern = public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN
    ids = bpe.encode(docs.select("doc_id", "lang", "source", "text"), ranks, pattern)
    return bpe.decode(ids, ranks, pattern).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("round_trip"))


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", benchmark),
          ("secret_scan", secrets), ("bpe_encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written before the next begins."""
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settle(docs, name)
    return docs
