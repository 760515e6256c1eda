"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's documents.

Every stage works on all its predecessor kept and returns the columns of ``documents``; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierflow.llm.common import table
from tierflow.llm.decontaminate import drop_contaminated
from tierflow.llm.mixing import mix
from tierflow.llm.neardup import drop_near_duplicates
from tierflow.llm.quality import keep_good
from tierflow.llm.sharding import shard_documents
from tierflow.session import materialize

SHARDS = 16


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie far from every language reference go."""
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at 0.8 or more, the smallest id stays."""
    return drop_near_duplicates(docs, width=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a test item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    return mix(docs, keep=True)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the shard and their place in it."""
    return shard_documents(docs, SHARDS, keep=True)


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Divergence thresholds on sums of logarithms and the sketches have no exact SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
