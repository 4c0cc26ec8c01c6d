"""What the corpus operators share: pinned intermediates, words and their hashes, running totals over huge groups."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenkeel.plans.keyed import scratch_path

# A word is a run of other characters than blank, tab, line feed, vertical tab, form feed and carriage return; on
# UTF-8 bytes ``bytes.split()`` cuts at exactly these six.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Entries a worker's word cache may hold before it starts anew.
CACHE_WORDS = 200_000

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the query that made them is written."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, so that nothing later repeats its work."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores added where a column has the name already."""
    taken = {column.lower() for column in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
        taken.add(name.lower())
    return found


def text_bytes(column: str = "text") -> Column:
    return F.col(column).cast("binary")


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def chunks(batches: Iterable[pd.DataFrame], column: str, max_bytes: int) -> Iterator[pd.DataFrame]:
    """Regroup Arrow batches so that each holds about ``max_bytes`` of ``column``; a longer text comes alone."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if batch.empty:
            continue
        lengths = batch[column].map(lambda x: 0 if x is None else len(x)).to_numpy()
        cut = (np.cumsum(lengths) - lengths) // max_bytes
        for part in np.unique(cut):
            rows = batch[cut == part]
            held.append(rows)
            size += int(lengths[cut == part].sum())
            if size >= max_bytes or sum(map(len, held)) >= 50_000:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.Table]:
    """Regroup Arrow batches so that each table holds about ``max_bytes`` of the binary ``column``, or 50,000 rows."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = min(int(np.searchsorted(ends, before + max_bytes - size)) + 1, at + 50_000 - rows, batch.num_rows)
            held.append(batch.slice(at, end - at))
            size, rows, at = size + int(ends[end - 1]) - before, rows + end - at, end
            if size >= max_bytes or rows >= 50_000:
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def words_in(text: bytes | None, table: bytes, slice_bytes: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, some at a time, after its bytes went through ``table``; there a word ends at a blank."""
    folded = (text or b"").translate(table)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + slice_bytes)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class Numbers(dict):
    """Words numbered in the order of their first look-up."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


class WordHashes(dict):
    """64-bit hashes by word, kept for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


HASHES = WordHashes()

# What a worker keeps between batches, by how to drop it.
_KEPT: list[Callable[[], None]] = [HASHES.clear]


def drop_at_end(drop: Callable[[], None]) -> None:
    """Have ``drop`` called when a task of :func:`tidy` ends."""
    _KEPT.append(drop)


def tidy(function: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's function that leaves nothing behind in its worker: workers are used again, by stages that need other
    things, and wait between tasks beside an executor's heap."""

    @wraps(function)
    def run(*args, **options) -> Iterator:
        try:
            yield from function(*args, **options)
        finally:
            for drop in _KEPT:
                drop()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:  # hands freed memory back to the system, where the C library can
                trim(0)

    return run


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def rolling_hash(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2^64, of every window of ``width`` words; built by doubling."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    n = len(hashes) - width + 1
    result, done = np.zeros(n, np.uint64), 0
    power, span = hashes, 1
    remaining = width
    while remaining:
        if remaining & 1:
            shift = np.uint64(pow(base, span, 1 << 64))
            result = result * shift + power[done : done + n]
            done += span
        remaining >>= 1
        if remaining:
            shift = np.uint64(pow(base, span, 1 << 64))
            power = power[:-span] * shift + power[span:]
            span *= 2
    return result


def scrambled(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads 64-bit values evenly."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and lengths of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return first, np.diff(np.append(first, len(sorted_values)))


def running_total(
    rows: DataFrame, group: list[str], place: str, ties: list[str], value: str, buckets: Column, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group that come before in the order of ``place``.

    ``place`` is a uniform double from 0 to below 1. The group is cut by place into ``buckets`` equal ranges, so no
    task holds a whole group: with about the square root of the group's rows as buckets, both the windows within the
    buckets and the one over the bucket sums hold about that many rows. ``rows`` is read twice, so pin it first.
    """
    cut = rows.withColumn("_bucket", F.floor(F.col(place) * buckets))
    within = Window.partitionBy(*group, "_bucket").orderBy(place, *ties).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*group, "_bucket").agg(F.sum(value).alias("_sum"))
    offsets = sums.select(*group, "_bucket", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_before"))
    inner = cut.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = [inner[c].eqNullSafe(offsets[c]) for c in [*group, "_bucket"]]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    return inner.join(offsets, condition).select(
        *[inner[c] for c in rows.columns], (F.col("_before") + F.col("_inner")).alias(name)
    )


def at_most(rows: DataFrame, place: Column, count: int, most: int) -> DataFrame:
    """About the first ``most`` of ``count`` rows in the order of ``place``, and never fewer but by chance of one in a
    billion: what a following ``limit`` would take, chosen by the place alone, so that a task does not send ``most`` rows
    of its own."""
    if count <= most:
        return rows
    return rows.where(place < (most + 6 * most**0.5 + 20) / count)


def hashed_place(*columns: str | Column) -> Column:
    """A double from 0 to below 1, the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / float(1 << 53)
