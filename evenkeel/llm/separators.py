"""Token counts by a separator scan over flat, unindexed token files.

A token file is a run of fixed-width token ids in which an end-of-document id closes each document; there is no index.
It is read in blocks that are cut without regard to documents. Each block is searched for the id in one vectorised
comparison. A prefix scan over the blocks' summaries (tokens, separators, last separator) gives every block its offset,
its first document's number and the start of the document that is open at its beginning, so that counts of documents
which cross any number of blocks come out right.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import pin, text_bytes
from evenkeel.llm.tokens import TOKENIZER, packed_texts, word_ids

END_OF_TEXT = 49407
BLOCK_BYTES = 1 << 20
CHUNK_BYTES = 4 << 20
WIDTHS = {2: "<u2", 4: "<u4"}


def token_file_blocks(
    docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END_OF_TEXT, block_bytes: int = BLOCK_BYTES, width: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Write ``docs`` (doc_id, text) as flat token files, one per task: the blocks (file, block, data), and the order in
    which documents went in (file, number, doc_id), which the files themselves do not tell.

    The strings of special tokens in a text are ordinary text, so the end id occurs only as a separator. A null or
    empty text is the end id alone.
    """
    names = ["kind", "file", "block", "data", "number", "doc_id"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, file = word_ids(tokenizer, plain=True), TaskContext.get().partitionId()
        rest, block, number = b"", 0, 0
        mark = np.array([end], WIDTHS[width]).tobytes()

        def rows(kind: str, blocks: list[bytes], ids: list) -> pa.RecordBatch:
            n = len(blocks) + len(ids)
            columns = [
                [kind] * n,
                [file] * n,
                [block + i for i in range(len(blocks))] or [None] * n,
                blocks or [None] * n,
                [number + i for i in range(len(ids))] or [None] * n,
                ids or [None] * n,
            ]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            texts, ids = batch["body"].to_pylist(), batch["doc_id"].to_pylist()
            at = 0
            while at < len(texts):
                past, size = at, 0
                while past < len(texts) and (past == at or size < CHUNK_BYTES):
                    size += len(texts[past] or b"")
                    past += 1
                packed = packed_texts(texts[at:past], known)
                found = np.frombuffer(b"".join(packed), "<u4")
                if len(found) and (int(found.max()) >= 1 << 8 * width or (found == end).any()):
                    raise ValueError(f"token ids of {tokenizer} do not fit into {width} bytes, or a text holds the end id {end}")
                rest += b"".join(np.frombuffer(p, "<u4").astype(WIDTHS[width]).tobytes() + mark for p in packed)
                whole = len(rest) // block_bytes * block_bytes
                if whole:
                    parts = [rest[i : i + block_bytes] for i in range(0, whole, block_bytes)]
                    yield rows("block", parts, [])
                    block, rest = block + len(parts), rest[whole:]
                yield rows("order", [], ids[at:past])
                number, at = number + past - at, past
        if rest:
            yield rows("block", [rest], [])

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    schema = "kind string, file long, block long, data binary, number long, doc_id long"
    written = pin(body.mapInArrow(write, schema), "token-files")
    blocks = written.where("kind = 'block'").select("file", "block", "data")
    return blocks, written.where("kind = 'order'").select("file", "number", "doc_id")


def read_token_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks (file, block, data) of raw binary token files below ``path``; a file is at most 2 GB, Spark's limit."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    block = F.explode(F.sequence(F.lit(0), F.floor((F.greatest(F.length("content"), F.lit(1)) - 1) / block_bytes)))
    return files.select("file", block.cast("long").alias("block"), "content").select(
        "file", "block", F.substring("content", F.col("block") * block_bytes + 1, F.lit(block_bytes)).alias("data")
    )


def scan_separators(blocks: DataFrame, end: int = END_OF_TEXT, width: int = 2) -> DataFrame:
    """Documents of flat token files given as blocks (file, block, data): file, number, start, n_tokens, closed.

    ``number`` counts a file's documents from 0, ``start`` is the document's first token, ``n_tokens`` leaves out the end
    id. Tokens after a file's last end id are one more document with ``closed`` false. A null or empty block holds no
    tokens; a file without tokens has no document. A block's length must be a multiple of ``width``.
    """

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places = [], []
            for data in batch["data"].to_pylist():
                ids = np.frombuffer(data or b"", WIDTHS[width])
                sizes.append(len(ids))
                places.append(np.flatnonzero(ids == end))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int32)
            flat = np.concatenate(places) if places else np.zeros(0, np.int64)
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))
            yield pa.record_batch(
                [batch["file"], batch["block"], pa.array(sizes, pa.int64()), found], ["file", "block", "size", "found"]
            )

    file_type = blocks.schema["file"].dataType.simpleString()
    schema = f"file {file_type}, block long, size long, found array<long>"
    cells = pin(blocks.select("file", F.col("block").cast("long").alias("block"), "data").mapInArrow(search, schema), "blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last_block = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The scan carries three numbers a block; the found places stay behind.
    summary = cells.select("file", "block", "size", F.size("found").alias("n"), F.try_element_at("found", F.lit(-1)).alias("last"))
    summary = summary.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    summary = summary.withColumns(
        {
            "first": F.coalesce(F.sum("n").over(before), F.lit(0)),
            "open": F.coalesce(F.last(F.col("offset") + F.col("last") + 1, ignorenulls=True).over(before), F.lit(0)),
            "final": F.col("block") == F.max("block").over(last_block),
        }
    ).select("file", "block", "offset", "first", "open", "final")
    joined = cells.join(summary, ["file", "block"])
    ends = F.transform("found", lambda x: x + F.col("offset"))
    total = F.col("offset") + F.col("size")
    tail = F.when(F.size("found") > 0, F.try_element_at(ends, F.lit(-1)) + 1).otherwise(F.col("open"))
    starts = F.concat(F.array("open"), F.transform(ends, lambda x: x + 1))
    closed = F.transform(
        F.arrays_zip(F.slice(starts, 1, F.size("found")).alias("s"), ends.alias("e")),
        lambda x: F.struct(x["s"].alias("start"), (x["e"] - x["s"]).alias("n_tokens"), F.lit(True).alias("closed")),
    )
    rest = F.when(
        F.col("final") & (total > tail),
        F.array(F.struct(tail.alias("start"), (total - tail).alias("n_tokens"), F.lit(False).alias("closed"))),
    )
    documents = F.concat(closed, F.coalesce(rest, F.array().cast("array<struct<start: bigint, n_tokens: bigint, closed: boolean>>")))
    return joined.select("file", "first", F.posexplode(documents)).select(
        "file", (F.col("first") + F.col("pos")).alias("number"), "col.start", "col.n_tokens", "col.closed"
    )


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per row of ``docs``: doc_id, file, number, start, n_tokens, from the flat token files made of them."""
    blocks, order = token_file_blocks(docs, tokenizer)
    return order.join(scan_separators(blocks), ["file", "number"]).select("doc_id", "file", "number", "start", "n_tokens")
