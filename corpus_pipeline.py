"""A corpus pipeline: each stage works on what its predecessor kept, written as Parquet and read again.

Rows are judged by their texts. NULL texts count as empty (the quality rules reject them); rows without a doc_id go
through every stage; rows that share a doc_id but not their text stay apart until packing, which gives the pieces of each; of
rows with one doc_id and one text a single one stays. Further columns are kept up to packing. Empty tables give an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vitaspan.llm import decontaminate, packing, quality_rules, simhash, toxicity
from vitaspan.llm.common import table
from vitaspan.session import checkpoint_root


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the lexicon is learned from labelled rows among ``docs``."""
    return toxicity.keep_harmless(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and offsets."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Scores, thresholds and packing are not expressible in SQL; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; rows are those of the last stage."""
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
