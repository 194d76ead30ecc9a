"""Corpus pipeline: quality, near duplicates, benchmark passages, secrets, packing.

Each stage gets all rows its predecessor kept and returns the columns of ``documents``; the last
one returns the packed pieces. A stage's result is written as Parquet and read back, so that a
lost executor never takes a run further back than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybridge.llm.byte_cnn import fit_quality, keep_quality
from daybridge.llm.decontaminate import remove_contaminated
from daybridge.llm.graph import stored
from daybridge.llm.near_dup import keep_one_of_each
from daybridge.llm.packing import pack_documents
from daybridge.llm.queries import BYTE_BPE, KEEP_SCORE, SEQUENCE_TOKENS, table
from daybridge.llm.secrets import redact_secrets
from daybridge.llm.shipping import shipped


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of these documents, does not reject."""
    return keep_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), KEEP_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows the text."""
    clean = redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences."""
    return pack_documents(docs, BYTE_BPE, end_id=0, capacity=SEQUENCE_TOKENS)


STAGES = [
    ("quality_classifier", shipped(quality)),
    ("near_duplicates", shipped(near_duplicates)),
    ("decontamination", shipped(decontaminate)),
    ("secret_scan", shipped(secrets)),
    ("best_fit_packing", shipped(pack)),
]

#: A trained network and a tokenizer decide the rows: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
