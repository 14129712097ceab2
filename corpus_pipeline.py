"""The corpus pipeline: raw documents to token ids, in five stages.

Quality rules, near-duplicate removal, benchmark decontamination, removal of
personal data, token ids. Each stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.llm import bpe, decontaminate, jaccard_join, pii, quality_rules
from triploom.llm.queries import TOKENIZER, table
from triploom.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_documents(docs)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of similar documents."""
    return jaccard_join.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(
        F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with packed token ids, their number, and whether decoding
    them gives the text back."""
    coded = docs.withColumn("_coded", bpe.round_trip(spark, TOKENIZER)(F.col("text")))
    return coded.withColumns({
        "ids": F.col("_coded.ids"), "n_tokens": bpe.n_tokens(F.col("_coded.ids")),
        "round_trip": F.col("_coded.decoded") == F.coalesce(F.col("text"), F.lit(""))}).drop(
        "_coded")


STAGES = [
    ("quality_rules", quality_stage),
    ("jaccard_join", duplicate_stage),
    ("decontaminate", benchmark_stage),
    ("pii", private_stage),
    ("bpe", token_stage),
]

# Robust estimates and span models are beyond SQL: the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
