"""From raw documents to packed training sequences, in stages that each work on all that the one before kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs``; what a stage returns is
written as Parquet and read again as the next one's documents, so a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession

from venuelens.llm import decontamination, packing, pii, quality, simhash
from venuelens.llm.shared import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or a certified cutoff go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.first_of_each(docs, shingle=3, radius=3, seed=42)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence of at most 2048 tokens."""
    return packing.pack(docs, path("byte_bpe_50k.json"), length=2048, end_id=0).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("pii", personal_data),
    ("best-fit packing", packed),
]

#: SQL cannot express XXH64 fingerprints, random walks, boosted trees or tokenizers; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
