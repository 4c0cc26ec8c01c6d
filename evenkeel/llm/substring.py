"""Substring dedup: Rabin-Karp hashes of every word window, counted in Spark, merged into removal intervals.

1. Map side: every window of ``width`` words is hashed (64 bits, plus a second hash that picks the fragment). Each
   chunk of about 2 MB of text keeps one entry per distinct window, its first place; later places in the chunk are
   known repeats and need no shuffle. So a window that makes up a third of all rows is sent once per chunk.
2. The entries are shuffled by fragment as packed arrays (hash, document, start: about 11 bytes a window). A fragment
   finds the first place of each hash in the order (doc_id, start); all other places are repeats.
3. Repeats are grouped by document and joined with the documents, where overlapping windows merge into maximal
   intervals.

Two different windows are taken for equal with a chance of 2^-64 / fragments a pair.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.llm.common import by_bytes, hash_words, pin, rolling_hash, runs, spare, text_bytes, tidy, total_bytes

WIDTH = 20
FRAGMENT_BYTES = 12 << 20  # text whose windows meet in one fragment
LEAST_FRAGMENTS = 64
CHUNK_BYTES = 2 << 20

_BASE, _SECOND_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_NO_ID = -(1 << 63)  # stands for a null doc_id: before all others
_PACKED = "frag long, ids binary, crcs binary, counts binary, hashes binary, low binary, high binary"
_REPEATS = "id long, crc long, starts binary"


def _arrow(schema: str) -> pa.Schema:
    fields = (field.split() for field in schema.split(", "))
    return pa.schema([(name, {"long": pa.int64(), "binary": pa.binary()}[kind]) for name, kind in fields])


def _crc(text: bytes | None) -> int:
    return zlib.crc32(text or b"")


class _Chunk:
    """The windows of some documents in the order (doc_id, start), and which of them come first in the chunk."""

    def __init__(self, rows: pd.DataFrame, width: int) -> None:
        rows = rows.sort_values("id", kind="stable", ignore_index=True)
        split = [text.split() if text else [] for text in rows["body"]]
        self.ids = rows["id"].to_numpy(np.int64)
        self.crcs = np.fromiter(map(_crc, rows["body"]), np.int64, len(rows))
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        ends = np.cumsum(lengths)
        hashes = hash_words([word for words in split for word in words])
        of_word = np.repeat(np.arange(len(split)), lengths)
        n = max(len(hashes) - width + 1, 0)
        whole = np.flatnonzero(np.arange(n) + width <= ends[of_word[:n]])
        self.doc = of_word[whole]
        self.start = whole - (ends - lengths)[self.doc]
        self.hash = rolling_hash(hashes, width, _BASE)[whole]
        self.second = rolling_hash(hashes, width, _SECOND_BASE)[whole]
        order = np.argsort(self.hash, kind="stable")
        first, size = runs(self.hash[order])
        head = np.repeat(order[first], size)
        # Rows that share a doc_id are told apart by start alone; equal places are both first.
        same = (self.ids[self.doc[order]] == self.ids[self.doc[head]]) & (self.start[order] == self.start[head])
        self.repeat = np.zeros(len(whole), bool)
        self.repeat[order] = ~same
        self.lead = np.zeros(len(whole), bool)
        self.lead[order] = same


def _by_document(ids: np.ndarray, crcs: np.ndarray, starts: np.ndarray) -> pd.DataFrame:
    order = np.lexsort((starts, crcs, ids))
    ids, crcs, starts = ids[order], crcs[order], starts[order].astype(np.int32)
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (crcs[1:] != crcs[:-1])
    first = np.flatnonzero(new)
    return pd.DataFrame(
        {
            "id": ids[first],
            "crc": crcs[first],
            "starts": [part.tobytes() for part in np.split(starts, first[1:])] if len(first) else [],
        }
    )


@tidy
def _packed(batches: Iterable[pa.RecordBatch], width: int, fragments: int) -> Iterator[pa.RecordBatch]:
    # A batch is cut before it is made into Python objects: it may hold many times a chunk's text.
    schema = _arrow(_PACKED)
    for rows in by_bytes(batches, "body", CHUNK_BYTES):
        c = _Chunk(rows.to_pandas(), width)
        entry = np.flatnonzero(c.lead)
        frag = (c.second[entry] >> np.uint64(32)) % np.uint64(fragments)
        kind = np.uint16 if fragments <= 1 << 16 else np.uint64
        order = np.argsort(frag.astype(kind), kind="stable")
        entry, frag = entry[order], frag[order].astype(np.int64)
        out = []
        for at, size in zip(*runs(frag)):
            own = entry[at : at + size]
            head, counts = runs(c.doc[own])
            docs, starts = c.doc[own[head]], c.start[own]
            ids = c.ids[docs]
            out.append(
                (
                    int(frag[at]),
                    np.diff(ids, prepend=np.int64(0)).tobytes(),
                    c.crcs[docs].astype(np.uint32).tobytes(),
                    counts.astype(np.uint32).tobytes(),
                    c.hash[own].tobytes(),
                    (starts & 0xFFFF).astype(np.uint16).tobytes(),
                    (starts >> 16).astype(np.uint16).tobytes(),
                )
            )
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema)


@tidy
def _known_repeats(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for rows in by_bytes(batches, "body", CHUNK_BYTES):
        c = _Chunk(rows.to_pandas(), width)
        own = np.flatnonzero(c.repeat)
        found = _by_document(c.ids[c.doc[own]], c.crcs[c.doc[own]], c.start[own])
        yield pa.RecordBatch.from_pandas(found, _arrow(_REPEATS), preserve_index=False)


def _joined(parts: Iterable[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _fragment_repeats(group: pd.DataFrame) -> pd.DataFrame:
    hashes = _joined(group["hashes"], np.uint64)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    shared = np.zeros(len(hashes), bool)
    np.equal(hashes[1:], hashes[:-1], out=shared[1:])
    shared[:-1] |= shared[1:]
    # Most windows occur once; places are looked up for the others only.
    order, hashes = order[shared], hashes[shared]
    counts = _joined(group["counts"], np.uint32)
    doc = np.repeat(np.arange(len(counts), dtype=np.uint32), counts)[order]
    ids = np.concatenate([np.cumsum(np.frombuffer(x, np.int64)) for x in group["ids"]])[doc]
    crcs = _joined(group["crcs"], np.uint32)[doc].astype(np.int64)
    starts = _joined(group["low"], np.uint16)[order].astype(np.int64)
    starts |= _joined(group["high"], np.uint16)[order].astype(np.int64) << 16
    inner = np.lexsort((starts, ids, hashes))
    ids, crcs, starts = ids[inner], crcs[inner], starts[inner]
    first, size = runs(hashes)
    head = np.repeat(first, size)
    later = (ids != ids[head]) | (starts != starts[head])
    return _by_document(ids[later], crcs[later], starts[later])


def fragments_for(size: int, fragment_bytes: int = FRAGMENT_BYTES) -> int:
    return max(LEAST_FRAGMENTS, math.ceil(size / fragment_bytes))


def repeated_starts(docs: DataFrame, width: int = WIDTH, fragment_bytes: int = FRAGMENT_BYTES) -> DataFrame:
    """(id, crc, parts): starts of the windows of a document that also start earlier, as packed 32-bit integers."""
    fragments = fragments_for(total_bytes(docs), fragment_bytes)
    body = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).cast("long").alias("id"), text_bytes().alias("body"))
    packed = body.mapInArrow(lambda batches: _packed(batches, width, fragments), _PACKED)
    across = packed.groupBy("frag").applyInPandas(_fragment_repeats, _REPEATS)
    inside = body.mapInArrow(lambda batches: _known_repeats(batches, width), _REPEATS)
    return across.unionByName(inside).groupBy("id", "crc").agg(F.collect_list("starts").alias("parts"))


def _strip(body: bytes | None, parts: list[bytes] | None, width: int) -> tuple[int, list[tuple[int, int]], bytes]:
    """Word count, removed spans and the kept words of one text."""
    words = body.split() if body else []
    if not parts:
        return len(words), [], b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    at = np.unique(_joined(parts, np.int32))
    change[at] += 1
    change[at + width] -= 1
    gone = np.cumsum(change)[:-1] > 0
    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    return len(words), edge.reshape(-1, 2).tolist(), b" ".join(np.array(words, object)[~gone].tolist())


def _with_repeats(docs: DataFrame, width: int, fragment_bytes: int, body: str, parts: str) -> DataFrame:
    """The documents with two more columns, ``body`` (the text's bytes) and ``parts`` (packed repeat starts, null: none)."""
    own_id, own_crc, its_id, its_crc = spare([*docs.columns, body, parts], "_id", "_crc", "_fid", "_fcrc")
    # Written first, so that the shuffle of the windows is gone before the texts are shuffled.
    found = pin(repeated_starts(docs, width, fragment_bytes), "repeats")
    found = found.withColumnsRenamed({"id": its_id, "crc": its_crc, "parts": parts})
    keyed = docs.withColumns(
        {
            body: text_bytes(),
            own_id: F.coalesce("doc_id", F.lit(_NO_ID)).cast("long"),
            own_crc: F.crc32(F.coalesce(text_bytes(), F.lit(b""))),
        }
    )
    joined = keyed.join(found, (F.col(own_id) == F.col(its_id)) & (F.col(own_crc) == F.col(its_crc)), "left")
    return joined.select(body, *[F.col(f"`{name}`") for name in docs.columns], parts)


def strip_repeats(docs: DataFrame, width: int = WIDTH, fragment_bytes: int = FRAGMENT_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string): doc_id, n_words, n_removed, spans, kept.

    ``spans`` lists the removed word ranges (first, past), ``kept`` is the UTF-8 text of the kept words, joined by one
    blank. A word goes if a window of ``width`` words covers it whose words also start earlier: in a document with a
    smaller doc_id, or earlier in the same one. All windows are judged on the input.

    Null and empty texts have no words and lose none. A text shorter than ``width`` loses none. A null doc_id comes
    before all others. Rows with one doc_id are ordered by start alone, so equal places of repeated rows keep each
    other. An empty table gives an empty result; other columns are not read.
    """

    @tidy
    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_body", CHUNK_BYTES):
            done = [_strip(b, p, width) for b, p in zip(batch["_body"].to_pylist(), batch["_parts"].to_pylist())]
            spans = [[{"first": a, "past": b} for a, b in x[1]] for x in done]
            removed = [sum(b - a for a, b in x[1]) for x in done]
            yield pa.record_batch(
                [
                    batch["doc_id"].combine_chunks(),
                    pa.array([x[0] for x in done], pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
                    pa.array([x[2] for x in done], pa.binary()),
                ],
                ["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _with_repeats(rows, width, fragment_bytes, "_body", "_parts").select("doc_id", "_body", "_parts").mapInArrow(
        strip, "doc_id long, n_words long, n_removed long, spans array<struct<first: long, past: long>>, kept binary"
    )


def without_repeats(docs: DataFrame, width: int = WIDTH, fragment_bytes: int = FRAGMENT_BYTES) -> DataFrame:
    """The documents with repeated passages cut out; texts that lose nothing stay as they are.

    ``text`` of a document that loses words is its kept words joined by one blank, ``n_chars``, where there is one, its
    new length. A document may end empty; its row stays. All other columns are carried as they are.
    """

    body, parts = spare(docs.columns, "_body", "_parts")
    names = [f"c{n}" for n in range(len(docs.columns))]  # own names may hold dots, which Python tasks do not take

    @tidy
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "body", CHUNK_BYTES):
            done = [_strip(b, p, width) for b, p in zip(batch["body"].to_pylist(), batch["parts"].to_pylist())]
            yield pa.record_batch(
                [pa.array([x[2] if x[1] else None for x in done], pa.binary())]
                + [batch[c].combine_chunks() for c in names],
                ["fresh", *names],
            )

    joined = _with_repeats(docs, width, fragment_bytes, body, parts).toDF("body", *names, "parts")
    carried = [T.StructField(name, field.dataType) for name, field in zip(names, docs.schema.fields)]
    cleared = joined.mapInArrow(cut, T.StructType([T.StructField("fresh", T.BinaryType()), *carried]))
    fresh = F.col("fresh").cast("string")
    outputs = []
    for name, field in zip(names, docs.schema.fields):
        column = F.col(name)
        if field.name == "text":
            column = F.coalesce(fresh, column)
        elif field.name == "n_chars":
            column = F.coalesce(F.length(fresh).cast(field.dataType), column)
        outputs.append(column.alias(field.name))
    return cleared.select(*outputs)
