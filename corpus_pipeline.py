"""Documents to packed training sequences, in stages that are each written and read again.

Rules drop poor documents, cross-site boilerplate lines go, one document of each near-duplicate group stays, documents
that hold benchmark items go, and what is left is packed. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import decontaminate, line_dedup, ngram_join, packing, quality_rules
from spanloom.llm.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that a rule rejects go."""
    return quality_rules.apply_rules(docs)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: repeated boilerplate lines go; so do documents that lose every word, whose lines all stand elsewhere."""
    done = line_dedup.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return done.where(left).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3, on shingles of five words at a similarity of 0.8: one document of each group stays."""
    return ngram_join.keep_one(docs, n=5, num=80).select(*docs.columns)


def leaks_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: pieces of the documents left, packed into sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules_stage),
    ("line_dedup", lines_stage),
    ("ngram_join", near_stage),
    ("decontamination", leaks_stage),
    ("packing", packing_stage),
]

#: Packing needs the tokenizer, which SQL can't express; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read as the next stage's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
