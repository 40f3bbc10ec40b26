"""A corpus pipeline over documents: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import stages
from tallyhouse.llm.common import table, written

STAGES = [
    ("language_id", stages.known_language),
    ("line_dedup", stages.without_repeated_lines),
    ("simhash_near_dedup", stages.one_of_each_group),
    ("benchmark_decontamination", stages.without_benchmark),
    ("sentencepiece", stages.as_pieces),
]

#: SQL has neither the merges of the last stage nor the 64-bit hash of the third.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's documents are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
