"""A corpus pipeline: five stages, each storing its documents as Parquet for the next.

Every stage but the last returns the columns of its input. Intermediate tables go to the scratch
folder under spark.checkpoint.dir; a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontamination, langid, neardup, packing, pii
from corpusloom.session import stored, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain."""
    return langid.keep_identified(spark, docs, sf_dir)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced."""
    return pii.redacted_documents(spark, docs, sf_dir)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in training sequences."""
    return packing.with_digest(packing.pack(docs))


STAGES = [("language ID", identified), ("near-dedup", deduplicated), ("decontamination", decontaminated), ("PII", redacted), ("packing", packed)]
#: Classifiers, signatures and tokenizers have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
