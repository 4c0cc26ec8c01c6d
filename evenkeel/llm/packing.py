"""Best-fit packing after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens. Lengths are few, so the packing is settled on the counts by
length (at most ``capacity`` numbers, whatever the corpus): first the reduction fixes sequences that provably dominate
all alternatives, whole classes of equal sequences at a time; then best fit, longest first, packs the rest. The answer
is a list of groups of equal sequences; the pieces of a length are numbered and find their place in it by a join.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import hashed_place, pin, running_total, text_bytes, tidy
from evenkeel.llm.tokens import TOKENIZER, packed_texts, word_ids

CAPACITY = 2048
END_ID = 0
CHUNK_BYTES = 4 << 20


@dataclass
class Group:
    """``bins`` sequences that hold the same lengths; ``contents`` lists (length, how many)."""

    bins: int
    contents: list[tuple[int, int]]


def _least(counts: dict[int, int], sizes: list[int], taken: list[int], how_many: int) -> int:
    """Sum of the ``how_many`` shortest pieces left besides ``taken``; infinite if there are fewer."""
    total, needed = 0, how_many
    for size in sizes:
        free = counts[size] - taken.count(size)
        use = min(free, needed)
        total, needed = total + use * size, needed - use
        if not needed:
            return total
    return math.inf


def _largest_pair(counts: dict[int, int], sizes: list[int], taken: int, room: int) -> int:
    """The largest sum of two pieces that fits ``room`` besides one piece of length ``taken``."""
    best, low, high = 0, 0, bisect_right(sizes, room) - 1
    while low <= high:
        first, second = sizes[low], sizes[high]
        enough = counts[first] - (first == taken) > 0 and counts[second] - (second == taken) > 0
        if first == second:
            enough = counts[first] - (first == taken) > 1
        if first + second > room:
            high -= 1
        else:
            if enough:
                best = max(best, first + second)
            if first == second:
                break
            if not enough and counts[second] - (second == taken) <= 0:
                high -= 1
            else:
                low += 1
    return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> list[Group]:
    """Fix sequences that dominate all others holding the same piece, and take their pieces out of ``counts``.

    For a piece j, longest first, with k the longest other piece that fits beside it, {j, k} is best if it fills the
    sequence, if no two further pieces fit beside j, or if no three do and no pair that fits is longer than k, as then
    any pair's places can be given to k and the pair be put where k was. {j} is best if nothing fits beside it.
    """
    fixed = []
    sizes = sorted(s for s, n in counts.items() if n)
    for size in reversed(list(sizes)):
        while counts.get(size, 0):
            room = capacity - size
            alone = [s for s in sizes if s <= room and counts[s] - (s == size) > 0]
            if not alone:
                fixed.append(Group(counts[size], [(size, 1)]))
                counts[size] = 0
                break
            partner = alone[-1]
            two, three = (_least(counts, sizes, [size], n) <= room for n in (2, 3))
            if partner != room and two and (three or _largest_pair(counts, sizes, size, room) > partner):
                break
            if partner == size:
                bins = counts[size] // 2
                fixed.append(Group(bins, [(size, 2)]))
                counts[size] -= 2 * bins
            else:
                bins = min(counts[size], counts[partner])
                fixed.append(Group(bins, [(size, 1), (partner, 1)]))
                counts[size] -= bins
                counts[partner] -= bins
        sizes = [s for s in sizes if counts[s]]
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[Group]:
    """Best fit, longest first, on classes: pieces of one length go to the fullest sequences that still take them."""
    open_groups: dict[int, list[Group]] = {}  # by room left
    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        left = counts[size]
        counts[size] = 0
        for room in sorted(r for r in open_groups if r >= size):
            if not left:
                break
            each = room // size
            groups, open_groups[room] = open_groups[room], []
            for group in groups:
                full = min(group.bins, left // each)
                parts = [(full, each)] if full else []
                left -= full * each
                rest = group.bins - full
                if rest and left:
                    parts.append((1, left))
                    left, rest = 0, rest - 1
                if rest:
                    open_groups[room].append(Group(rest, group.contents))
                for bins, n in parts:
                    grown = Group(bins, [*group.contents, (size, n)])
                    open_groups.setdefault(room - n * size, []).append(grown)
        if left:
            each = capacity // size
            for bins, n in ((left // each, each), (1 if left % each else 0, left % each)):
                if bins:
                    open_groups.setdefault(capacity - n * size, []).append(Group(bins, [(size, n)]))
    return [group for groups in open_groups.values() for group in groups]


def pack_counts(counts: dict[int, int], capacity: int) -> list[Group]:
    counts = dict(counts)
    return reduce_by_dominance(counts, capacity) + best_fit(counts, capacity)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and ``ids`` (packed) if asked for."""
    end = END_ID.to_bytes(4, "little")

    @tidy
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer)
        for batch in batches:
            texts, doc_ids = batch["body"].to_pylist(), batch["doc_id"].to_pylist()
            at = 0
            while at < len(texts):
                past, size = at, 0
                while past < len(texts) and (past == at or size < CHUNK_BYTES):
                    size += len(texts[past] or b"")
                    past += 1
                yield _pieces(doc_ids[at:past], packed_texts(texts[at:past], known), end, capacity, with_ids)
                at = past

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(cut, schema + (", ids binary" if with_ids else ""))


def _pieces(doc_ids: list, packed: list[bytes], end: bytes, capacity: int, with_ids: bool) -> pa.RecordBatch:
    columns: list[list] = [[], [], [], [], [], []]
    for doc_id, ids in zip(doc_ids, packed):
        ids += end
        for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
            part = ids[at : at + 4 * capacity]
            row = (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None)
            for column, value in zip(columns, row):
                column.append(value)
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    used = len(names) if with_ids else len(names) - 1
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns[:used], kinds)], names[:used])


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): the columns of ``token_pieces``, sequence_id, offset.

    A document is its token ids and the end id 0; only a longer one than ``capacity`` is cut. A null or empty text is
    the end id alone. Repeated rows are packed as often as they come. Pieces of equal length are interchangeable; they
    are numbered by doc_id and piece. An empty table gives an empty result; other columns are not read.
    """
    pieces = pin(token_pieces(docs, capacity, tokenizer, with_ids), "pieces")
    counts = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}
    places, sequences = [], 0
    reached = dict.fromkeys(counts, 0)
    for group in pack_counts(counts, capacity):
        offset = 0
        for length, n in group.contents:
            past = reached[length] + group.bins * n
            places.append((length, reached[length], past, sequences, n, offset))
            reached[length] = past
            offset += length * n
        sequences += group.bins
    schema = "length long, first long, past long, sequence long, each long, base long"
    spark = docs.sparkSession
    # As many rows as there are groups of equal sequences: bounded by the lengths, not by the corpus.
    lookup = F.broadcast(spark.createDataFrame(places, schema).withColumnRenamed("length", "_length"))
    roots = [(length, math.isqrt(n) or 1) for length, n in counts.items()]
    buckets = F.broadcast(spark.createDataFrame(roots, "_length long, _buckets long"))
    numbered = pieces.join(buckets, pieces.length == F.col("_length")).drop("_length")
    numbered = numbered.withColumns({"_place": hashed_place("doc_id", "piece", "ids_crc32"), "_one": F.lit(1)})
    ranked = running_total(numbered, ["length"], "_place", ["doc_id", "piece", "ids_crc32"], "_one", F.col("_buckets"), "_rank")
    place = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("past"))
    nth = F.col("_rank") - F.col("first")
    return ranked.join(lookup, place).select(
        *pieces.columns,
        (F.col("sequence") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("base") + nth % F.col("each") * F.col("length")).alias("offset"),
    )
