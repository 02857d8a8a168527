"""Corpus pipeline: five stages from raw documents to a training mix.

``run`` applies ``STAGES`` in order to ``documents``; what a stage returns is
written as Parquet in the shared scratch folder and read again by the next one.
All stages but the last return the columns of ``documents``; the last one adds
``mix_copy``, the number of the copy from 1 on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pixelframe.llm.base import read_table, stored
from pixelframe.llm.decontaminate import keep_clean
from pixelframe.llm.lines import without_repeated_lines
from pixelframe.llm.mixing import mixed_rows
from pixelframe.llm.rules import keep_good
from pixelframe.llm.simhash import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; ``n_chars`` follows the text."""
    return without_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_rows(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# SimHash (XXH64), components and the mix's draws have no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
