"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``vnodes`` places on a ring. A row belongs to the first place clockwise from the hash of its id; rows
that find a shard full go on clockwise to the next shard that is not. Rows of one arc (between two places) have the
same way ahead, so only the row counts of the arcs, at most shards * vnodes + 1 numbers, reach the driver; there the
overflow is settled arc by arc, and each arc is cut into runs of ranks with one shard each. Rows find their run by
their rank on the ring.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.common import hashed_place, pin, running_total, text_bytes

SHARDS = 8
VNODES = 128


@dataclass(frozen=True)
class Run:
    """Ranks ``first`` to below ``past`` of the ring go to ``shard``, at its slots from ``slot``."""

    first: int
    past: int
    shard: int
    slot: int


def ring(spark: SparkSession, shards: int, vnodes: int) -> list[tuple[float, int]]:
    """The virtual nodes (place, shard) in ring order; a place depends on the shard's number alone."""
    nodes = spark.range(shards * vnodes).selectExpr(f"id div {vnodes} as shard", f"id % {vnodes} as node")
    placed = nodes.select(hashed_place(F.lit("virtual node"), "shard", "node").alias("place"), "shard").collect()
    found: dict[float, int] = {}
    for place, shard in sorted((row.place, row.shard) for row in placed):
        found.setdefault(place, shard)
    return list(found.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows a shard may hold: with no slack the rows divided as evenly as can be, else (1 + slack) times the mean."""
    if slack > 0:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def ways(owners: list[int]) -> list[list[int]]:
    """For each arc the shards in the order in which they are met clockwise."""
    shards = set(owners)
    found = []
    for arc in range(len(owners)):
        way = dict.fromkeys(owners[arc:] + owners[:arc])
        found.append(list(way)[: len(shards)])
    return found


def settle(counts: list[int], owners: list[int], room: list[int]) -> list[Run]:
    """Cut the arcs' rows, in ring order, into runs. In round r every arc offers what it has left to the r-th shard of
    its way; a shard takes from the arcs in ring order until it is full."""
    way, left, free = ways(owners), list(counts), list(room)
    taken: list[list[tuple[int, int]]] = [[] for _ in counts]
    for turn in range(len(set(owners))):
        for arc, shards in enumerate(way):
            n = min(left[arc], free[shards[turn]])
            if n:
                taken[arc].append((shards[turn], n))
                left[arc] -= n
                free[shards[turn]] -= n
    slots, at, found = [0] * len(room), 0, []
    for parts in taken:
        for shard, n in parts:
            found.append(Run(at, at + n, shard, slots[shard]))
            slots[shard] += n
            at += n
    return found


def shard_rows(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, home, shard, slot.

    ``home`` is the shard at the first virtual node clockwise, ``shard`` where the row ends up: no shard holds more than
    its capacity, which without ``slack`` means that row counts differ by one at most. ``slot`` numbers a shard's rows
    from 0 without gaps. ``size`` is the text's UTF-8 bytes (null: none) plus 1, ``text_crc32`` of a null text that of
    the empty one. Rows with one id, and those with none, share a place on the ring and are ordered by a hash of id and
    text. Repeated rows get slots of their own. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    nodes = ring(spark, shards, vnodes)
    body = F.coalesce(text_bytes(), F.lit(b""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        hashed_place("doc_id").alias("place"),
        # Order within an arc: by id and text, as a third of all rows may share one id, or have none.
        hashed_place("doc_id", F.crc32(body), F.lit("slot")).alias("within"),
        F.lit(1).alias("one"),
    )
    edges = [-math.inf, *[place for place, _ in nodes], math.inf]
    on_ring = Bucketizer(splits=edges, inputCol="place", outputCol="arc").transform(rows)
    on_ring = pin(on_ring.withColumn("arc", F.col("arc").cast("int")), "ring")
    counts = [0] * (len(nodes) + 1)
    for arc, n in on_ring.groupBy("arc").count().collect():
        counts[arc] = n
    # Arc i ends at node i; the last one goes on to the first node.
    owners = [shard for _, shard in nodes] + [nodes[0][1]]
    total = sum(counts)
    found = settle(counts, owners, capacities(total, shards, slack))
    starts = [0]
    for n in counts[:-1]:
        starts.append(starts[-1] + n)
    lookup = [
        (arc, owners[arc], r.first - starts[arc], r.past - starts[arc], r.shard, r.slot) for arc, r in _by_arc(found, starts, counts)
    ]
    schema = "arc int, home int, first long, past long, shard int, slot0 long"
    bounded = spark.createDataFrame(lookup, schema)  # at most shards * (vnodes + shards) rows
    buckets = F.lit(max(1, math.isqrt(max(counts))))
    ranked = running_total(on_ring, ["arc"], "within", ["doc_id", "text_crc32", "size"], "one", buckets, "rank")
    joined = ranked.join(F.broadcast(bounded), "arc").where("rank >= first and rank < past")
    return joined.select(
        "doc_id", "size", "text_crc32", "home", "shard", (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot")
    )


def _by_arc(found: list[Run], starts: list[int], counts: list[int]) -> list[tuple[int, Run]]:
    out, arc = [], 0
    for run in found:
        while run.first >= starts[arc] + counts[arc]:
            arc += 1
        out.append((arc, run))
    return out
