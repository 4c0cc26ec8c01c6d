"""One registered query per corpus operator, each over its whole table with production parameters."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.html_text import main_text
from evenkeel.llm.jaccard import jaccard_groups
from evenkeel.llm.lexical import build_index, search
from evenkeel.llm.maxent import score_texts
from evenkeel.llm.mixing import mixed_sizes
from evenkeel.llm.neighbours import nearest_neighbours
from evenkeel.llm.packing import pack
from evenkeel.llm.prefix_trie import prefix_trie
from evenkeel.llm.quality import judge
from evenkeel.llm.separators import token_counts
from evenkeel.llm.sharding import shard_rows
from evenkeel.llm.substring import strip_repeats
from evenkeel.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable for the Python workers, unless PYTHONPATH already does."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _SHIPPED:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/evenkeel", "zip", root, "evenkeel")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixed_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_rows(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = strip_repeats(table(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_mix,
        op2_toxicity,
        op3_shard,
        op4_pack,
        op5_token_counts,
        op6_main_text,
        op7_quality,
        op8_jaccard,
        op9_neighbours,
        op10_substring,
        op11_lm_score,
        op12_prefix_trie,
        op13_lexical_search,
    )
}
