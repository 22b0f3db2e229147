"""Documents to packed training sequences: quality rules, near-duplicates, secrets, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. All but the last return the
columns of documents. ``run`` writes each stage's result to the shared folder and reads it for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import line_rules, mixing, packing, queries, secret_scan, simhash
from quayside.llm.words import table
from quayside.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep."""
    return line_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    queries.importable(spark)
    return simhash.keep_one(docs, width=4, radius=4)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; ``n_chars`` follows the text."""
    queries.importable(spark)
    clean = secret_scan.redact(docs)
    if "n_chars" not in clean.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them, those taken twice as two rows."""
    return mixing.sample(docs, F.array("source"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    queries.importable(spark)
    return packing.pack(docs, queries.vocabulary(), capacity=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("packing", packed),
]
ORACLE_SQL = None  # SimHash groups, redaction and packing have no SQL; tests hold the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{number}")
    return docs
