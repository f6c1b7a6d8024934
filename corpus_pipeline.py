"""The training-data pipeline: five operators over ``documents``, one after the other.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet
and read again as the next one's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusforge.llm import length_buckets, line_dedup, quality_llr, simhash_bits, temperature_mix
from corpusforge.llm.common import shared_folder, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_llr.judge(docs, quality_llr.fit(docs, trusted), keep_columns=True)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat over documents stay in one; ``n_chars`` follows the text."""
    return line_dedup.drop_repeated_lines(docs, keep_columns=True, length_col="n_chars")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest id."""
    return simhash_bits.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to the repetition limit."""
    return temperature_mix.apply(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return length_buckets.pack(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_deduplication), ("simhash_near_dedup", simhash_near_dedup),
          ("mix_sources", mix_sources), ("packing", pack)]

#: The stages hash with functions that DuckDB lacks; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; intermediates go to a new folder beside the checkpoints."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            at = f"{folder}/{i}-{name}"
            docs.write.parquet(at)
            docs = spark.read.parquet(at)
    return docs
