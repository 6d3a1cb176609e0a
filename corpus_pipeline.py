"""The corpus pipeline: quality rules, line dedup, near-dedup, PII, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before
kept; all but the last return the columns of ``documents``.  ``run`` writes
each stage as Parquet in the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from racelake.llm import line_dedup, near_dup, packing, pii, quality
from racelake.llm.common import read_table, ship, written
from racelake.llm.tokenizing import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op2: documents that fail the base or a rule go."""
    return quality.keep_good(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op10: lines of 20 or more code points in three or more documents stay in one."""
    return line_dedup.remove_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op5: one document of each group stays (five words, similarity 0.8)."""
    return near_dup.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op7: personal data and the terms that disclose it are replaced in the text."""
    return pii.sanitise(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op9: pieces of sequences of 4096 tokens."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", packing_stage),
]

#: Tokenization and sketches have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
