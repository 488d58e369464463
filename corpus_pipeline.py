"""Corpus clean-up pipeline: STAGES run in order, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. Decisions are taken by one of the training-data operators
and take effect in the same stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quiver.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from quiver.llm.common import pin, read_table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise quality ranking rejects go (operator 9)."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"), cut=0.3)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space one stays (operator 2)."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents at 5-word shingle similarity 0.8 or more, the smallest
    id stays (operator 5)."""
    return near_dedup.drop_near_duplicates(docs, words=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % or more of a benchmark item's 5-word shingles go (operator 1)."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 1024 ids (operator 3); one row per piece."""
    return packing.pack(docs, size=1024, end_id=0)


STAGES = [("quality", quality_filter), ("exact_dedup", exact_copies), ("near_dedup", near_copies),
          ("decontaminate", benchmark_leaks), ("packing", pack)]

#: The fitted ranking and the token ids cannot be written as SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents, each written as Parquet and reread as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
