"""From documents to packed training sequences: quality, near-duplicates, repeated passages, mix, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. ``run`` writes each stage's result
to the shared scratch folder and reads it back, so a lost executor costs one stage's work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evenkeel.llm import stages
from evenkeel.llm.common import pin
from evenkeel.llm.queries import ship, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return stages.drop_poor(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return stages.one_of_each_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return stages.cut_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return stages.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return stages.pack_sequences(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

# Learned rules, token ids and hash orders cannot be stated in SQL; tests/llm checks the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per packed piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
