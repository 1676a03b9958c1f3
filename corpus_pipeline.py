"""The corpus pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusflow.llm import jaccard_join, language_id, packing, quality_rules, secret_scan
from corpusflow.llm.scratch import Scratch


def rules_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the latest rule policy rejects go."""
    return quality_rules.keep_documents(docs)


def language_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language, or in one with a score below 0.4, go."""
    return language_id.keep_known(docs, language_id.fit(docs))


def duplicates_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays."""
    return jaccard_join.keep_one(docs, words=5, percent=80)


def secrets_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return secret_scan.redact(docs)


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of 2048 ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", rules_stage),
    ("language_id", language_stage),
    ("jaccard_join", duplicates_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]
#: SQL can express neither the trained network nor best-fit packing; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for _, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
