"""The corpus pipeline: five stages, each written and read again before the next.

Toxic documents go, documents that fail the quality rules go, one document of each group of
near duplicates stays, secrets are replaced in the texts, and what is left is packed into
training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adsphere.llm import minhash, packing, quality_rules, secrets, toxicity
from adsphere.llm.tables import table
from adsphere.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents whose score reaches the rejection score go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that fail the base rules or diverge from their language go."""
    return quality_rules.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each group of near duplicates stays."""
    return minhash.keep_one_of_each(docs)


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: secrets that are not widely copied examples become a placeholder."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: what is left, as pieces placed in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("minhash", drop_near_duplicates),
    ("secret_scan", replace_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: The learned toxicity stage cannot be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
