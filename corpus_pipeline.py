"""From raw documents to a training mix: five stages, each written as Parquet before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but
the last return the columns of documents; the last returns what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weatherloom.llm import decontaminate, mixing, pii, quality, simhash
from weatherloom.llm.registry import table
from weatherloom.llm.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the others stay as they are."""
    return quality.apply_rules(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the least doc_id."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words of benchmark items go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses get pseudonyms of their format."""
    return pii.replace_pii(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document, so that sources come to their target weights."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminated),
    ("pii_pseudonyms", pseudonymised),
    ("mixing_sources", mixed),
]

#: SQL cannot express the fingerprints, the permutations and the rounding; a plain version of all
#: stages is the test.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
