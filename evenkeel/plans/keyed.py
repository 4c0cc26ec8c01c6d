"""Two-pass work on huge keyed tables.

The comparison operators first shuffle a *narrow profile* (key, a few numbers) and keep the keys that matter.
That set is written to the shared checkpoint folder, so its size is known and no later stage depends on the
shuffle files of the first pass. The second pass fetches full rows for just those keys:

* set within ``Limits.broadcast_bytes``: broadcast it, so the big table is filtered where it is read and never
  shuffled;
* larger: shuffle both sides, with the rows of hot keys spread over several slices. Before that the rows are tested
  where they are read against a Bloom filter of the key set, so that of a table with few anomalies little is shuffled.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evenkeel.functions.columns import quoted


@dataclass(frozen=True)
class Limits:
    """Size bounds for the second pass.

    ``broadcast_bytes``  largest key set that may be broadcast.
    ``hot_rows``         a key with more rows than this is hot (raised on very large tables, see below).
    ``hot_keys``         most keys that can be hot: the bound is ``total_rows / hot_keys`` rows, so the
                         broadcast list of hot keys can never hold more entries than this.
    ``reread_share``     share of rows to report beyond which a table is read a second time rather than
                         shuffling those rows.
    """

    broadcast_bytes: int = 256 << 20
    hot_rows: int = 1_000_000
    hot_keys: int = 100_000
    reread_share: float = 0.1

    def rows_per_slice(self, total_rows: int) -> int:
        return max(self.hot_rows, math.ceil(total_rows / self.hot_keys), 1)


DEFAULT_LIMITS = Limits()

# Estimated bytes of one key set row in a broadcast hash table, without the key texts.
ROW_OVERHEAD_BYTES = 150

# Keys per 64-bit word of the Bloom filter, its most words (a broadcast table of about 50 bytes a word), and bits a key.
_WORD_KEYS = 6
_MOST_WORDS = 1 << 21
_KEY_BITS = 3

_WORD = "_ek_word"
_BITS = "_ek_bits"
_SET = "_ek_set"
_WEIGHT = "_ek_weight"
_SLICE = "_ek_slice"
_HOT = "_ek_hot"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediates: the session's ``spark.checkpoint.dir``.

    A private folder is made only where that is unset and Spark runs inside one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="evenkeel-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/evenkeel/{label}-{uuid.uuid4().hex}"


@contextmanager
def buckets_as_sorted(spark: SparkSession) -> Iterator[None]:
    """Jobs in here take buckets of one file as sorted, so that they are aggregated and joined row by row, not in memory."""
    names = ["spark.sql.legacy.bucketedTableScan.outputOrdering", "spark.sql.execution.replaceHashWithSortAgg"]
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def pin(df: DataFrame, keep: str, stats: dict[str, str], label: str) -> tuple[DataFrame, dict[str, int]]:
    """Write the rows of ``df`` where ``keep`` holds, and measure all of ``df``, in one job."""
    spark = df.sparkSession
    seen = Observation()
    path = scratch_path(spark, label)
    measured = [F.expr(f"coalesce({expr}, 0) as {name}") for name, expr in stats.items()]
    df.observe(seen, *measured).where(keep).write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    found = seen.get
    return kept, {name: int(found[name]) for name in stats}


def key_bytes(keys: list[str]) -> str:
    """Estimated broadcast bytes of one key set row."""
    texts = "".join(f" + coalesce(octet_length(cast({quoted(k)} as string)), 0)" for k in keys)
    return f"cast({ROW_OVERHEAD_BYTES}{texts} as bigint)"


def sum_where(condition: str, value: str) -> str:
    return f"sum(case when {condition} then {value} end)"


def max_where(condition: str, value: str) -> str:
    return f"max(case when {condition} then {value} end)"


def maybe_among(rows: DataFrame, picked: DataFrame, on: list[str], keys: int) -> DataFrame:
    """The rows whose keys are picked, and a few others: those that pass a Bloom filter of ``keys`` picked keys.

    A key sets a few bits of one 64-bit word; the words are broadcast. With more keys than the words are made for, more
    other rows pass.
    """
    words = max(1, min(_MOST_WORDS, keys // _WORD_KEYS))
    digest = f"xxhash64(7L, {', '.join(quoted(k) for k in on)})"
    word = f"cast(pmod(shiftright({digest}, 20), {words}) as int) as {_WORD}"
    bits = " | ".join(f"shiftleft(1L, cast(shiftright({digest}, {6 * i}) & 63 as int))" for i in range(_KEY_BITS))
    filled = picked.selectExpr(word, f"{bits} as {_BITS}").groupBy(_WORD).agg(F.bit_or(_BITS).alias(_SET))
    marked = rows.selectExpr("*", word, f"{bits} as {_BITS}")
    return marked.join(F.broadcast(filled), _WORD).where(f"{_SET} & {_BITS} = {_BITS}").drop(_WORD, _BITS, _SET)


def _slice_count(weight: str, per_slice: int) -> str:
    return f"cast(greatest(ceil({weight} / {per_slice}), 1) as int)"


def spread(rows: DataFrame, weight: str, per_slice: int) -> DataFrame:
    """Give every row of a hot key one of the key's slices.

    The slice follows the input partition, so a repeated task assigns the same slices.
    """
    return rows.selectExpr("*", f"pmod(spark_partition_id(), {_slice_count(weight, per_slice)}) as {_SLICE}")


def replicate(rows: DataFrame, weight: str, per_slice: int) -> DataFrame:
    """Repeat a key's row once per slice; in total at most ``rows + total_rows / per_slice`` rows."""
    return rows.selectExpr("*", f"explode(sequence(0, {_slice_count(weight, per_slice)} - 1)) as {_SLICE}")


def keyed_join(
    rows: DataFrame,
    picked: DataFrame,
    on: list[str],
    how: str,
    picked_bytes: int,
    hot: DataFrame | None,
    hot_weight: str,
    per_slice: int,
    limits: Limits,
) -> DataFrame:
    """Join a big table with a key set (one row per key), whatever the set's size and the table's skew.

    ``hot`` lists the keys with more than ``per_slice`` rows in the big table (None: there are none). It is broadcast as
    pairs of a 64-bit digest and a number, so its size is bounded by the number of hot keys, however long their texts
    are. A key that shares a digest with a hot one is spread as well, on both sides, which changes no result.
    """
    if picked_bytes <= limits.broadcast_bytes:
        return rows.join(F.broadcast(picked), on, how)
    if hot is None:
        return rows.join(picked, on, how)
    digest = f"xxhash64({', '.join(quoted(k) for k in on)}) as {_HOT}"
    lookup = hot.selectExpr(digest, f"{hot_weight} as {_WEIGHT}").groupBy(_HOT).agg(F.max(_WEIGHT).alias(_WEIGHT))
    lookup = F.broadcast(lookup)
    weight = f"coalesce({_WEIGHT}, 1)"
    rows = spread(rows.selectExpr("*", digest).join(lookup, _HOT, "left"), weight, per_slice).drop(_WEIGHT, _HOT)
    picked = replicate(picked.selectExpr("*", digest).join(lookup, _HOT, "left"), weight, per_slice).drop(_WEIGHT, _HOT)
    return rows.join(picked, [*on, _SLICE], how).drop(_SLICE)


def fetch(
    rows: DataFrame,
    picked: DataFrame,
    on: list[str],
    weight: str,
    picked_bytes: int,
    heaviest: int,
    total_rows: int,
    limits: Limits,
    task_rows: int | None = None,
) -> DataFrame:
    """Full rows of the picked keys. ``weight`` is the number of rows a key has in ``rows``.

    Keys without a row there are dropped first, which also tells the optimizer that the key set is selective: it
    may then test the rows against a Bloom filter before it shuffles them.
    """
    per_slice = limits.rows_per_slice(total_rows)
    picked = picked.where(f"{weight} > 0")
    hot = picked.where(f"{weight} > {per_slice}") if heaviest > per_slice else None
    if picked_bytes > limits.broadcast_bytes and picked_bytes // ROW_OVERHEAD_BYTES < total_rows // 2:
        rows = maybe_among(rows, picked, on, picked_bytes // ROW_OVERHEAD_BYTES)
    if task_rows and hot is None and picked_bytes > limits.broadcast_bytes:
        # For aggregates above the join, whose memory the bytes shuffled do not tell: tasks are not merged by those.
        usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(max(usual, math.ceil(total_rows / task_rows)), *[F.col(quoted(k)) for k in on])
    return keyed_join(rows, picked, on, "inner", picked_bytes, hot, weight, per_slice, limits)


def nothing(df: DataFrame) -> DataFrame:
    """The same columns without rows; the planner drops everything below."""
    return df.where("false")
