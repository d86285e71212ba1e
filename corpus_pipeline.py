"""Corpus pipeline: quality, line dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its output is written as Parquet and read again.  All but the last return
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortia.llm import line_dedup, minhash, mixing, packing, quality
from cohortia.llm.queries import tokenizer
from cohortia.llm.scratch import store


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches go, and documents left without a word."""
    return line_dedup.drop_repeated_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (80 % of five-word shingles) stays."""
    return minhash.one_of_each_group(docs, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time that the mix takes a document."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 4096-token sequences."""
    return packing.pack_documents(docs, tokenizer())


STAGES = [("quality", quality_stage), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

#: The classifier's perplexities, MinHash buckets and the tokenizer can't be said in SQL;
#: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
