"""Pipeline stages: ``(spark, docs, sf_dir) -> docs``.

Each works on all rows its predecessor kept. All but the last return the columns of ``docs`` as they
are (any extra or clashing ones included), with rows removed or texts changed.

The filtering stages first write their rows with a number of their own. Only number and text go
through the operators, and the numbers of rows that go come back in an anti join, so nulls
and repeated ids need no special case and whole rows never pass through Python. An empty table stays
empty; very long texts are handled as in the operators.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.llm import bpe
from cohort.llm.catalog import tokenizer_path
from cohort.llm.common import numbered, whole_row, without
from cohort.llm.contamination import contamination
from cohort.llm.near_duplicates import near_duplicates
from cohort.llm.secret_scan import redacted, secret_spans
from cohort.llm.toxicity import toxicity
from cohort.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that the classifier scores at 0.5 or more; null and empty texts are scored as such."""
    table, uid = numbered(docs, "toxicity-rows")
    scored = toxicity(table, read_table(spark, sf_dir, "labels"), carry=uid)
    return without(table, scored.where("predicted = 1").select(F.col("row").alias("uid")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate component, whatever its doc_id (null or repeated too).

    Rows without words are linked with nothing and stay.
    """
    table, uid = numbered(docs, "near-duplicate-rows")
    return without(table, near_duplicates(table, id_col=uid).where(~F.col("kept")).select(F.col("doc_id").alias("uid")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that the benchmark contaminates; all others, those without words too, stay as they are."""
    table, uid = numbered(docs, "contamination-rows")
    found = contamination(table, read_table(spark, sf_dir, "benchmark"), carry=uid)
    return without(table, found.where("contaminated").select(F.col("row").alias("uid")))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret span in the texts; rows, null texts and other columns stay."""
    rows, name = whole_row(docs)
    found = secret_spans(rows, carry=name)
    clean = found.select("row", redacted(F.col("text"), F.concat("assign", "access", "hex", "entropy", "parts")).alias("clean"))
    at = docs.columns.index("text")
    return clean.select(*[(F.col("clean") if i == at else F.col(f"row._c{i}")).alias(c)
                          for i, c in enumerate(docs.columns)])


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``[doc_id, n_tokens, ids, decoded]``: token ids of every text and the text they decode to.

    Null texts count as empty; an empty table gives no rows.
    """
    return bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"), decoded=True)
