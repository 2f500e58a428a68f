"""The corpus pipeline: quality rules, near duplicates, benchmark contamination, personal data, packing.

Every stage works on all that the one before it kept and is written as Parquet in the shared folder and read again.
All stages but the last return the columns of documents. Rows are judged by their text, whatever their doc_id: of rows
that repeat one, or have none, each gets its own verdict, and of near copies the one with the smallest doc_id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidtable.llm import decontaminate, packing, pii, quality_rules, simhash
from evidtable.llm.common import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the new text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in sequences."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", private), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenizers and fingerprints are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None
