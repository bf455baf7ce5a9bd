"""Corpus pipeline: toxicity, near-duplicates, contamination, secrets, BPE.

``STAGES`` are applied in order to ``documents``; each stage's rows are written as
Parquet under the shared checkpoint folder and read back before the next, so a lost
executor costs one stage at most. Every stage but the last returns the columns of
``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohort.llm import stages
from cohort.llm.common import written
from cohort.sources.tables import read_table

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("near_duplicates", stages.drop_near_duplicates),
    ("contamination", stages.drop_contaminated),
    ("secrets", stages.redact_secrets),
    ("bpe", stages.encode_texts),
]

# Learned and hashed stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
