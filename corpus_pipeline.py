"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet in the shared folder and hands what was written
to the next.  All stages but the last return the columns of ``documents``; the
last adds what the mix takes of each document (``_size``, ``_target``,
``_taken``; documents of which nothing is taken are left out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emporia.llm import decontam, line_dedup, minhash, mixing, quality
from emporia.llm.common import staged
from emporia.session import apply_defaults
from emporia.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    apply_defaults(spark)
    return quality.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay in one of them."""
    apply_defaults(spark)
    return line_dedup.without_repeated_lines(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    apply_defaults(spark)
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    apply_defaults(spark)
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix and how many of their words it takes."""
    apply_defaults(spark)
    return mixing.mix(docs, mixing.label_weights(table(spark, sf_dir, "labels")))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_deduplication", line_deduplication),
    ("near_deduplication", near_deduplication),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: Hashed keys order the mix and sketches find common words; SQL can't express either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
