"""Corpus pipeline: from raw documents to packed training sequences.

Each stage calls one operator, is written as Parquet to the shared folder, and
the next one reads that back as its documents.  All but the last return the
columns of ``documents``.  No stage swallows errors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.llm import ordinal, packing, pii, simhash, substring
from paceline.llm.common import documents, spool
from paceline.llm.queries import PATTERN, TARGETS, VOCABULARY


def _recount(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now (null text: as it was)."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier keeps."""
    return ordinal.select_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each SimHash component."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 20-word windows that start earlier; a text that is
    all repeated stays as an empty one."""
    return _recount(substring.remove_repeats(docs).select(*[F.col(f"`{c}`") for c in docs.columns]))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return _recount(pii.redact(docs, pii.train(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_documents(docs, VOCABULARY, PATTERN, packing.present(docs, TARGETS))


STAGES = [("quality_classifier", quality), ("simhash_near_dedup", near_duplicates),
          ("substring_dedup", repeated_passages), ("pii", personal_data), ("packing", packed)]

# A fitted classifier and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
