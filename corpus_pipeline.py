"""Training-data pipeline: documents -> quality rules -> line dedup -> near duplicates -> repeated
strings -> packed windows.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but
the last return the columns of documents; their text is what the stage left of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowsift.llm import catalog, jaccard_join, line_runs, pack_nnls, quality_rules, suffix_dedup
from flowsift.llm.scratch import land


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and the learned rules do not reject."""
    return quality_rules.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs leave the texts."""
    return line_runs.deduped_documents(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that a smaller document holds too leave the texts."""
    return suffix_dedup.deduped_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, placed in windows."""
    return pack_nnls.digests(pack_nnls.pack(docs, catalog.ENGLISH, catalog.PATTERN))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_near_copies),
    ("suffix_dedup", drop_repeated_strings),
    ("packing", pack),
]

#: The learned rules and the packing are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
