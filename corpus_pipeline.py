"""From documents to training tokens: STAGES in order; each works on all that the one before it kept.

In every stage a null text counts as empty, an empty text is a document like another (without words it has no windows, shingles
or tokens), texts of any length are read whole, null and repeated ids lose no clean document, columns that are not named in the
stage are handed on whatever their names, and an empty table gives an empty one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.llm import bpe, common, contamination, exact_dedup, near_dedup, quality
from clinflow.llm.common import scratch, table

#: Word shingles of the near-duplicate stage.
NEAR_WORDS = 5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id (null is the last), of equal ids the text with the smallest SHA-256."""
    return near_dedup.drop_near_copies(docs, width=NEAR_WORDS)


def without_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than a twentieth of test items' windows."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens and ids."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encoded(docs.select("doc_id", "source", "lang", "text"), path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_contamination),
    ("byte-level BPE", tokens),
]

#: SQL can't express the classifier or the tokenizer; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again, and what the stages before it wrote goes."""
    docs, since = table(spark, sf_dir, "documents"), len(common.MADE)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = scratch(spark, f"stage{k}")
        out.write.parquet(path)
        common.discard(spark, since, path)
        docs = spark.read.parquet(path)
    return docs
