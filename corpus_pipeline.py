"""Corpus pipeline: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.llm.common import read_table, saved
from framewise.llm.decontam import decontaminate
from framewise.llm.lines import dedup_lines
from framewise.llm.queries import bpe_digests
from framewise.llm.rules import fit, keep_good
from framewise.llm.simhash import simhash_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores 0.7 or more; it learns from the labelled ones among
    ``docs``."""
    return keep_good(docs, fit(docs, read_table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them hold."""
    kept = dedup_lines(docs, min_docs=10, min_chars=1).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component."""
    return simhash_dedup(docs, shingle=4, max_bits=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no contaminating share of the benchmark."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    return bpe_digests(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark), ("bpe", tokens)]

#: The classifier, the fingerprints and the tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
