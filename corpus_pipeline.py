"""The training-data pipeline: quality, exact and near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps,
with all their columns; the last returns the packed pieces.  ``run`` writes
every stage's result as Parquet under the shared scratch folder and reads it
again, so a lost executor repeats no earlier stage.

Odd rows go by the operators' rules: null and empty texts are scored, compared
and packed like any other; a row without ``doc_id`` cannot be linked or reported
and stays (but for its score, or an equal text with an id); of repeated rows one
stays; extra columns, whatever their names, are carried through up to packing;
empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from posgraph.llm import decontaminate, exact, neardup, packing, quality
from posgraph.llm.common import table, tokenizer_path
from posgraph.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is not below the cut."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every normalised text."""
    return exact.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group."""
    return neardup.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces (with their ids) of what is left, packed into sequences; ``packing.sequences`` joins them."""
    return packing.best_fit(docs, tokenizer_path(), with_ids=True)


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage),
          ("benchmark", benchmark_stage), ("packing", packing_stage)]

# Learned scores and tokenizer ids have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
