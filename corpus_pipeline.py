"""A corpus from the documents table: quality rules, near duplicates, decontamination, mixing, token tables.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and is written as Parquet and read
again for the next. All but the last return the columns of documents; the last returns a row for each document in
the token tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, mixing, quality_rules, set_join, token_tables
from tidemark.llm._shared import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.keep_good(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each connected group the document of the smallest doc_id stays."""
    return set_join.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it."""
    return mixing.keep_mixed(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token tables are written and read back."""
    return token_tables.tokenised(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token tables", tokenise),
]

#: Tokenising is not SQL. tests/llm/test_pipeline.py holds the stages in a row against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
