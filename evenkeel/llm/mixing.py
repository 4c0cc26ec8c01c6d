"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

1. Each source gets a target in words; targets are cut off at a multiple of the source's size and the excess is shared
   out again by weight.
2. A source's documents are shuffled by a hash of their id and laid end to end; every ``block`` words are one block.
   A target is so many whole passes over the blocks plus a last part.
3. The schedule walks the van der Corput points (base 2). A point times the number of slots falls into the cumulative
   quotas of the sources, so every source is drawn exactly as often as its quota asks and evenly over the schedule.
4. The slots of a source are ranked; rank r takes block r modulo the number of blocks. Blocks and slots are joined.

DataFrame functions only. A source may hold any share of the rows: running totals work on hash ranges of a source.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import WORD_PATTERN, hashed_place, pin, running_total

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_PASSES = 2
BLOCK = 1024


@dataclass(frozen=True)
class Mix:
    """``pieces``: one row per document and slot that takes words of it: doc (see ``documents``), slot, block, pass,
    first (word of the document), words. ``documents``: doc, doc_id, source, size, source_size, target, begin, carried columns.
    ``schedule``: slot, source, rank, block, pass, words."""

    documents: DataFrame
    schedule: DataFrame
    pieces: DataFrame


def word_count(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most_passes: int) -> DataFrame:
    """Add ``weight`` and ``target`` to (source, source_size): one row per source, few and narrow.

    Weights repeat over the sources in code-point order, a null source last. The excess over ``most_passes`` times a
    source's size is shared by weight until no target is above: all sources whose limit is small for their weight stay
    at it, the others get one common number of words per unit of weight.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1))
    named = named.withColumn("limit", F.col("source_size") * F.lit(float(most_passes)))
    named = named.withColumn("_ratio", F.col("limit") / F.col("weight"))
    below = everything.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    from_here = everything.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    wanted = F.least(F.sum("source_size").over(everything) * F.lit(share), F.sum("limit").over(everything))
    level = (wanted - F.coalesce(F.sum("limit").over(below), F.lit(0.0))) / F.sum("weight").over(from_here)
    named = named.withColumn("_level", level)
    # The first source, by ratio, that its share does not fill sets the level for all that follow.
    common = F.min(F.when(F.col("_level") < F.col("_ratio"), F.struct("_ratio", "_level"))).over(everything)
    named = named.withColumn("_common", common["_level"])
    target = F.when(F.col("_common").isNull(), F.col("limit")).otherwise(
        F.least(F.col("limit"), F.col("weight") * F.col("_common"))
    )
    return named.withColumn("target", target).select("source", "source_size", "weight", "target")


def _reversed_bits(value: Column, bits: int) -> Column:
    """The van der Corput point of ``value`` in base 2, as an integer below 2^bits."""
    return F.conv(F.reverse(F.lpad(F.bin(value), bits, "0")), 2, 10).cast("long")


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_passes: int = MOST_PASSES,
    block: int = BLOCK,
    carried: tuple[str, ...] = (),
) -> Mix:
    """Mix ``docs`` (doc_id, source, text) so that the words taken from each source come to its target.

    Null and empty texts have size 0 and are never taken. A null source is a source of its own, after all others.
    Repeated rows are documents of their own (``doc`` is unique in one result, not across runs; equal rows may change
    places). Without any word there is no slot. Other columns are not read; ``carried`` ones are handed to ``documents``.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"),
        F.xxhash64("text").alias("mark"), *carried
    )
    # Many rows may share an id, or have none: their texts tell them apart.
    rows = own.withColumn("doc", F.monotonically_increasing_id()).withColumn("place", hashed_place("doc_id", "mark"))
    rows = pin(rows, "mix-documents")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    sources = pin(source_targets(totals.drop("_rows"), weights, share, most_passes), "mix-sources")
    longest = totals.agg(F.max("_rows")).first()[0] or 0
    buckets = F.lit(max(1, math.isqrt(longest)))
    placed = running_total(rows, ["source"], "place", ["doc_id", "mark", "size"], "size", buckets, "begin")
    documents = placed.join(sources, placed.source.eqNullSafe(sources.source)).select(
        "doc", "doc_id", placed.source.alias("source"), "size", "source_size", "target", "begin", *carried
    )

    # Quotas: whole passes over a source's blocks, and the blocks of the last, partial pass.
    words = F.round("target").cast("long")
    quota = sources.where(words > 0).select(
        "source",
        "source_size",
        words.alias("words"),
        F.ceil(F.col("source_size") / block).cast("long").alias("blocks"),
    )
    left = F.col("words") % F.col("source_size")
    quota = quota.withColumn(
        "quota", F.expr("words div source_size") * F.col("blocks") + F.ceil(left / block).cast("long")
    )
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    quota = pin(quota.withColumn("first_slot", F.coalesce(F.sum("quota").over(before), F.lit(0))), "mix-quotas")
    slots = quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    bits = max(1, (max(slots, 1) - 1).bit_length())

    # A source is a range of points; ranges of equal length stand for it so that points find it by an equal key.
    step = max(1, slots // 4096)
    ranges = quota.where("quota > 0").withColumn(
        "cell",
        F.explode(F.sequence(F.expr(f"first_slot div {step}"), F.expr(f"(first_slot + quota - 1) div {step}"))),
    )
    points = docs.sparkSession.range(1 << bits).select(F.col("id").alias("slot"), _reversed_bits(F.col("id"), bits).alias("point"))
    points = points.where(F.col("point") < slots).withColumn("cell", F.expr(f"point div {step}"))
    drawn = points.join(ranges, "cell").where("point >= first_slot and point < first_slot + quota")
    drawn = pin(
        drawn.select("slot", "source", "source_size", "words", "blocks", (F.col("slot") / float(1 << bits)).alias("place"), F.lit(1).alias("one")),
        "mix-slots",
    )
    ranked = running_total(drawn, ["source"], "place", ["slot"], "one", F.lit(max(1, math.isqrt(slots))), "rank")
    nth, turn = F.col("rank") % F.col("blocks"), F.expr("rank div blocks")
    whole = F.least(F.lit(block), F.col("source_size") - nth * block)
    due = F.col("words") - turn * F.col("source_size") - nth * block
    schedule = ranked.select(
        "slot", "source", "rank", nth.alias("block"), turn.alias("pass"), F.least(whole, due).alias("words")
    )

    end = F.col("begin") + F.col("size") - 1
    parts = documents.where("size > 0").select(
        "doc", F.col("source").alias("_source"), "begin", "size",
        F.explode(F.sequence(F.expr(f"begin div {block}"), F.floor(end / block))).alias("_block"),
    )
    joined = parts.join(schedule, parts._source.eqNullSafe(schedule.source) & (parts._block == schedule.block))
    low = F.greatest("begin", F.col("block") * block)
    high = F.least(F.col("begin") + F.col("size"), F.col("block") * block + F.col("words"))
    pieces = joined.select(
        "doc", "slot", "source", "block", "pass", (low - F.col("begin")).alias("first"), (high - low).alias("words")
    ).where("words > 0")
    return Mix(documents, schedule, pieces)


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, taken (words the mix takes, repeats counted)."""
    mix = mix_sources(docs, **options)
    taken = mix.pieces.groupBy(F.col("doc").alias("_doc")).agg(F.sum("words").alias("_taken"))
    return mix.documents.join(taken, mix.documents.doc == taken._doc, "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).alias("taken")
    )
