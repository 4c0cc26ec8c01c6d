"""Ranked lexical search: Block-Max MaxScore over compressed posting lists in document shards.

1. ``build_index`` cuts the documents into shards of some 16 MB of text. A shard has one row per term: its postings in
   blocks of 128, each posting a document's place in the shard and the term's gain there, as variable-length bytes,
   and for each block its last place and greatest gain. All terms of all documents are indexed, so one index answers
   any number of item sets.
2. ``search`` takes the items in bounded sets, fetches the rows of their terms, and knows each term's weight and its
   bound over all shards. In a shard, terms whose bounds together cannot lift a document into the item's heap are
   non-essential: only documents of the others are candidates. Candidates are held against the block maxima of the
   non-essential lists first, and only blocks that can still matter are unpacked, each at most once per shard.
3. A task carries its heaps from shard to shard, so later shards are pruned by what earlier ones found; the heaps of
   all tasks are merged by rank.

Scores are whole numbers and exact: bounds only decide what need not be looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import Numbers, by_bytes, pin, runs, text_bytes, words_in

# Fixed values of the score: a term is a run of ASCII letters, digits and characters beyond ASCII.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
SHARD_BYTES = 16 << 20  # text in one shard
BLOCK = 128  # postings in a block
FIRST_WINDOW, WINDOW = 512, 4096  # places looked at between two updates of an item's threshold
ITEM_BYTES = 4 << 20  # text of the items that are searched together

_NO_ID = (1 << 63) - 1  # stands for a null doc_id: after all others
_INDEX = "shard long, term binary, n long, top long, lasts binary, maxima binary, ends binary, data binary"

# Letters to lower case, digits and bytes beyond ASCII as they are, all other bytes a blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

Batches = Iterable[pa.RecordBatch]


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, low ones first, the top bit set on all but a value's last byte; and where each value ends."""
    size = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        more = values >= (1 << bits)
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    start = ends - size
    for k in range(int(size.max()) if len(size) else 0):
        own = np.flatnonzero(size > k)
        out[start[own] + k] = ((values[own] >> (7 * k)) & 0x7F) | ((size[own] > k + 1).astype(np.int64) << 7)
    return out, ends


def unpack(packed: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(packed < 128) + 1
    start = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    size = ends - start
    values = np.zeros(len(ends), np.int64)
    for k in range(int(size.max()) if len(size) else 0):
        own = np.flatnonzero(size > k)
        values[own] |= (packed[start[own] + k].astype(np.int64) & 0x7F) << (7 * k)
    return values


def _column(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    """A binary column: row i has the values from starts[i] to starts[i + 1]."""
    offsets = (starts * values.itemsize).astype(np.int64)
    column = pa.Array.from_buffers(
        pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )
    return column.cast(pa.binary())


def _shard_rows(shard: int, ids: np.ndarray, texts: list[bytes | None], n_docs: int, n_terms: int) -> pa.RecordBatch | None:
    """One row per term, and one without a term that holds the documents' ids."""
    numbers = Numbers()
    found, lengths = [], np.zeros(len(texts), np.int64)
    for place, text in enumerate(texts):
        for some in words_in(text, _FOLD):
            found.append(np.fromiter(map(numbers.__getitem__, some), np.int64, len(some)))
            lengths[place] += len(some)
    if not numbers:
        return None
    key = np.sort(np.concatenate(found) * len(texts) + np.repeat(np.arange(len(texts)), lengths))
    first, times = runs(key)
    term, place = np.divmod(key[first], len(texts))
    middle = 50 + (50 * lengths * n_docs) // n_terms
    gain = (1_000_000_000 * times) // (1000 * times + 20 * middle[place])

    head, size = runs(term)
    at = np.arange(len(term)) - np.repeat(head, size)
    block = np.flatnonzero(at % BLOCK == 0)
    ahead = np.concatenate([[0], place[:-1]])
    ahead[block] = 0
    packed, value_ends = pack(np.stack([place - ahead, gain], 1).ravel())
    block_end = np.append(block[1:], len(term))
    data_ends = value_ends[2 * block_end - 1]
    of_term = np.append(np.searchsorted(block, head), len(block))  # the first block of each term
    term_start = np.concatenate([[0], data_ends])[of_term]
    maxima = np.maximum.reduceat(gain, block)
    relative = data_ends - np.repeat(term_start[:-1], np.diff(of_term))
    columns = [
        pa.array(np.full(len(head), shard)),
        pa.array(list(numbers), pa.binary()),
        pa.array(size),
        pa.array(np.maximum.reduceat(gain, head)),
        _column(of_term, place[block_end - 1].astype(np.int32)),
        _column(of_term, maxima.astype(np.int64)),
        _column(of_term, relative.astype(np.int32)),
        _column(term_start, packed),
    ]
    own = [[shard], [b""], [len(texts)], [0], [b""], [b""], [b""], [ids.astype(np.int64).tobytes()]]
    names = [part.split()[0] for part in _INDEX.split(", ")]
    columns = [pa.concat_arrays([c, pa.array(o, c.type)]) for c, o in zip(columns, own)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _shards(batches: Batches, n_docs: int, n_terms: int) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 24
    for number, part in enumerate(by_bytes(batches, "body", SHARD_BYTES)):
        ids = pc.fill_null(part.column("id"), _NO_ID).to_numpy()
        rows = _shard_rows(first + number, ids, part.column("body").to_pylist(), n_docs, n_terms)
        if rows:
            yield rows


@dataclass(frozen=True)
class Index:
    """``rows``: one per shard and term, written to the shared folder; ``n_docs`` documents have ``n_terms`` terms."""

    rows: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Index:
    """Index every document and every term. Null texts and texts without a term are no documents of the index."""
    found = F.regexp_count(F.col(text), F.lit(TERM_PATTERN)).cast("long")
    counts = docs.select(found.alias("n")).agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = int(counts.docs or 0), int(counts.terms or 0)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("body"))
    built = rows.mapInArrow(lambda batches: _shards(batches, n_docs, max(n_terms, 1)), _INDEX)
    return Index(pin(built, "lexical-index"), n_docs, n_terms)


class _Postings:
    """A term's list in one shard; blocks are unpacked when asked for, once."""

    def __init__(self, n: int, lasts: bytes, maxima: bytes, ends: bytes, data: bytes) -> None:
        self.lasts = np.frombuffer(lasts, np.int32)
        self.maxima = np.frombuffer(maxima, np.int64)
        self.ends = np.frombuffer(ends, np.int32)
        self.data = np.frombuffer(data, np.uint8)
        self.place = np.zeros(n, np.int64)
        self.gain = np.zeros(n, np.int64)
        self.known = np.zeros(len(self.lasts), bool)

    def open(self, blocks: np.ndarray) -> None:
        blocks = blocks[~self.known[blocks]]
        if not len(blocks):
            return
        start = np.where(blocks > 0, self.ends[blocks - 1], 0)
        if blocks[-1] - blocks[0] + 1 == len(blocks):
            packed = self.data[start[0] : self.ends[blocks[-1]]]
        else:
            packed = np.concatenate([self.data[a:b] for a, b in zip(start.tolist(), self.ends[blocks].tolist())])
        values = unpack(packed).reshape(-1, 2)
        size = np.minimum((blocks + 1) * BLOCK, len(self.place)) - blocks * BLOCK
        before = np.cumsum(size) - size
        total = np.cumsum(values[:, 0])
        total -= np.repeat(np.where(before > 0, total[before - 1], 0), size)
        slots = np.arange(len(values)) - np.repeat(before - blocks * BLOCK, size)
        self.place[slots], self.gain[slots] = total, values[:, 1]
        self.known[blocks] = True

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Places from ``low`` to below ``high`` and the gains there."""
        first = int(np.searchsorted(self.lasts, low))
        end = min(int(np.searchsorted(self.lasts, high)) + 1, len(self.lasts))
        if first >= end:
            return self.place[:0], self.gain[:0]
        self.open(np.arange(first, end))
        at = first * BLOCK
        a, b = np.searchsorted(self.place[at : end * BLOCK], [low, high])
        return self.place[at + a : at + b], self.gain[at + a : at + b]

    def gains(self, places: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Gains at sorted places that lie in the given blocks; 0 where the term does not occur."""
        wanted = np.unique(blocks)
        self.open(wanted)
        slots = (wanted[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        slots = slots[slots < len(self.place)]
        at = np.searchsorted(self.place[slots], places)
        at = slots[np.minimum(at, len(slots) - 1)]
        return np.where(self.place[at] == places, self.gain[at], 0)


class _Heap:
    """An item's best documents so far."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.need = 1  # a document with a lower score cannot enter

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.append(self.score, score), np.append(self.doc, doc)
        best = np.lexsort((doc, -score))[: self.top]
        self.score, self.doc = score[best], doc[best]
        if len(best) == self.top:
            self.need = max(int(self.score[-1]), 1)


def search_shard(heap: _Heap, lists: list[tuple[int, int, _Postings]], ids: np.ndarray) -> None:
    """Take one item's documents of a shard into its heap. ``lists``: weight, bound over all shards, postings."""
    lists = sorted(lists, key=lambda x: x[1])
    bounds = np.cumsum([bound for _, bound, _ in lists])
    low = 0
    while low < len(ids):
        essential = int(np.searchsorted(bounds, heap.need))
        if essential == len(lists):
            return
        high = min(low + (WINDOW if low else FIRST_WINDOW), len(ids))
        scores = np.zeros(high - low, np.int64)
        for weight, _, postings in lists[essential:]:
            place, gain = postings.between(low, high)
            scores[place - low] += weight * gain
        places = np.flatnonzero(scores)
        found = scores[places]
        places += low
        for i in range(essential - 1, -1, -1):
            weight, _, postings = lists[i]
            alive = found + bounds[i] >= heap.need
            places, found = places[alive], found[alive]
            if not len(places):
                break
            block = np.searchsorted(postings.lasts, places)
            inside = block < len(postings.lasts)
            most = np.where(inside, weight * postings.maxima[np.minimum(block, len(postings.lasts) - 1)], 0)
            alive = found + most + (bounds[i - 1] if i else 0) >= heap.need
            places, found, block, inside = places[alive], found[alive], block[alive], inside[alive]
            if inside.any():
                found[inside] += weight * postings.gains(places[inside], block[inside])
        good = found >= heap.need
        if good.any():
            heap.add(found[good], ids[places[good]])
        low = high


@dataclass(frozen=True)
class _Items:
    """What a task needs to know of a set of items; bounded by ``ITEM_BYTES`` of their text."""

    weight: dict[bytes, int]
    bound: dict[bytes, int]
    terms: list[list[bytes]]


def _best(batches: Batches, items: _Items, top: int) -> Iterator[pa.RecordBatch]:
    heaps = [_Heap(top) for _ in items.terms]
    held: dict[bytes, _Postings] = {}
    ids, shard = np.zeros(0, np.int64), None

    def finish() -> None:
        for heap, wanted in zip(heaps, items.terms):
            lists = [(items.weight[t], items.bound[t], held[t]) for t in wanted if t in held]
            if lists:
                search_shard(heap, lists, ids)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("shard", "term", "n", "lasts", "maxima", "ends", "data")]
        for own, term, *row in zip(*columns):
            if own != shard:
                finish()
                held, ids, shard = {}, np.zeros(0, np.int64), own
            if term == b"":
                ids = np.frombuffer(row[-1], np.int64)
            else:
                held[term] = _Postings(*row)
    finish()
    numbers = np.repeat(np.arange(len(heaps)), [len(heap.doc) for heap in heaps])
    docs = np.concatenate([np.zeros(0, np.int64), *[heap.doc for heap in heaps]])
    scores = np.concatenate([np.zeros(0, np.int64), *[heap.score for heap in heaps]])
    shown = pa.array(docs, mask=docs == _NO_ID)
    yield pa.RecordBatch.from_arrays([pa.array(numbers), shown, pa.array(scores)], names=["item", "doc_id", "score"])


def _search_set(index: Index, wanted: list[set[bytes]], top: int) -> DataFrame:
    """item (its place in ``wanted``), doc_id, score: every task's best documents."""
    spark = index.rows.sparkSession
    every = sorted(set().union(*wanted))
    asked = spark.createDataFrame([(bytearray(t),) for t in [b"", *every]], "term binary")
    hits = pin(index.rows.join(F.broadcast(asked), "term", "left_semi"), "lexical-hits")
    known = hits.where("term <> X''").groupBy("term").agg(F.sum("n").alias("df"), F.max("top").alias("top")).collect()
    weight, bound = {}, {}
    for row in known:
        term = bytes(row.term)
        weight[term] = math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * row.df + 1)))
        bound[term] = weight[term] * row.top
    items = _Items(weight, bound, [sorted(own & weight.keys()) for own in wanted])
    by_shard = hits.repartition("shard").sortWithinPartitions("shard")
    return by_shard.mapInArrow(lambda batches: _best(batches, items, top), "item long, doc_id long, score long")


def search(index: Index, items: DataFrame, item_id: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """The ``top`` best documents of every item: item_id, rank, doc_id, score.

    Rows with one item_id (a null one too) are one item with all their terms. Items without a term, or whose terms
    occur nowhere, have no rows, and so has everything where no document has a term. Repeated rows of a document are
    documents of their own; equal scores go by ascending doc_id, null last. Items come to the driver in sets of
    ``ITEM_BYTES`` of text, which bounds what is broadcast; each set is one pass over its terms' postings.
    """
    spark = items.sparkSession
    sets: list[tuple[list, list[set[bytes]]]] = []
    ids: list = []
    wanted: list[set[bytes]] = []
    size = 0
    kind = items.schema[item_id].dataType
    rows = items.select(F.col(item_id).alias("id"), text_bytes(text).alias("body")).orderBy("id")
    for row in rows.toLocalIterator():
        if size >= ITEM_BYTES and row.id != ids[-1]:
            sets.append((ids, wanted))
            ids, wanted, size = [], [], 0
        if not ids or row.id != ids[-1]:
            ids.append(row.id)
            wanted.append(set())
        for some in words_in(row.body and bytes(row.body), _FOLD):
            wanted[-1].update(some)
        size += len(row.body or b"")
    sets.append((ids, wanted))
    answers = None
    for ids, wanted in sets:
        names = spark.createDataFrame(list(enumerate(ids)), "item long, item_id " + kind.simpleString())
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = _search_set(index, wanted, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        found = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        answers = found if answers is None else answers.unionByName(found)
    return answers
