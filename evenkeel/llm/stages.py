"""The operators as steps over the documents table: each returns documents with its decisions carried out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import WORD_PATTERN, spare
from evenkeel.llm.jaccard import first_of_groups
from evenkeel.llm.mixing import mix_sources
from evenkeel.llm.packing import pack
from evenkeel.llm.quality import kept_documents
from evenkeel.llm.substring import without_repeats

# The near-duplicate rule of the stages; op8_jaccard has its own.
NEAR_WIDTH = 5
NEAR_PERCENT = 80


def drop_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the quality rules reject go."""
    return kept_documents(docs, labels)


def _digests(docs: DataFrame) -> tuple[Column, Column]:
    """Digests of doc_id and text, and of the whole row; maps, which have no order, are left out."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-")) for name in ("doc_id", "text")]
    same = F.md5(F.concat_ws(" ", *marked))
    others = [f for f in docs.schema.fields if f.name not in ("doc_id", "text") and "map<" not in f.dataType.simpleString()]
    # A null leaves a hash as it is, so nulls are told apart by name.
    nulls = F.concat_ws(" ", *[F.when(F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in others])
    return same, F.concat_ws(" ", same, F.hex(F.xxhash64(*[F.col(f"`{f.name}`") for f in others], nulls)))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """Near-duplicates share 80 percent of their five-word shingles. Of each group one row stays: the smallest doc_id,
    nulls last; of several texts or rows of that doc_id the one with the smallest digest, so reruns agree. Documents
    without words link with nothing and stay, once per doc_id and text."""
    digests = _digests(docs)
    narrow = docs.select("doc_id", "text", *[d.alias(name) for d, name in zip(digests, ("same", "row"))])
    (known,) = spare(docs.columns, "_row")
    kept = first_of_groups(narrow, NEAR_WIDTH, NEAR_PERCENT).select(F.col("row").alias(known))
    found = docs.withColumn(known, digests[1]).join(kept, known, "left_semi").dropDuplicates([known])
    return found.select(*[F.col(f"`{name}`") for name in docs.columns])


def cut_repeats(docs: DataFrame) -> DataFrame:
    """Passages that also start earlier go; a document that loses all its words here stays, with an empty text."""
    return without_repeats(docs)


def mix(docs: DataFrame) -> DataFrame:
    """The documents the mix takes, one row per pass; a document that is taken in part keeps that part of its text.
    Every row counts as a document of its own, whatever its doc_id.

    Only the last block of a source's last pass is cut, so per pass nearly all texts are whole and stay as they are.
    """
    own = spare(docs.columns, "_row", "_size", "_first", "_words")
    row = own[0]
    marked = docs.withColumn(row, _digests(docs)[1])
    mixed = mix_sources(marked.select("doc_id", "source", "text", row), carried=(row,))
    passes = mixed.pieces.groupBy("doc", "pass").agg(F.min("first").alias("_first"), F.sum("words").alias("_words"))
    taken = mixed.documents.select("doc", F.col(row).alias("_row"), F.col("size").alias("_size")).join(passes, "doc")
    taken = taken.select(*[F.col(name).alias(alias) for name, alias in zip(("_row", "_size", "_first", "_words"), own)])
    size, first, taken_words = map(F.col, own[1:])
    # Equal rows are documents of their own in the mix; here one stands for all, and each has its passes.
    joined = marked.dropDuplicates([row]).join(taken, row)
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD_PATTERN})"), F.lit(1))
    part = F.array_join(F.slice(words, first.cast("int") + 1, taken_words.cast("int")), " ")
    text = F.when(taken_words < size, part).otherwise(F.col("text"))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        length = F.length(part).cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(taken_words < size, length).otherwise(F.col("n_chars"))
    return joined.withColumns(columns).select(*[F.col(f"`{name}`") for name in docs.columns])


def pack_sequences(docs: DataFrame) -> DataFrame:
    """Training sequences: one row per piece, with its place in a sequence."""
    return pack(docs.select("doc_id", "text"))
