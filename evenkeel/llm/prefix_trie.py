"""Conversation prefix trie: double-array tries per prefix shard, shared upper nodes merged globally.

1. A turn becomes two 64-bit digests of role and text and a word count; texts are read once and never shuffled. Turns
   are put in order by range partitions: each partition numbers its own turns, and the one conversation that a
   partition shares with those before it gets an offset. So a conversation may be longer than a task.
2. A prefix is named by its depth and the exclusive or of two 64-bit digests of its (depth, turn) pairs, again run
   through range partitions. Conversations with the same last prefix are equal: one stands for all, with their number.
3. A prefix with more than ``shard_rows`` turns at or below it is an upper node. Everything below the first prefix
   that is not goes to one shard, whatever its siblings do, so a frequent first turn is cut further down.
4. A shard numbers its turns densely, packs BASE and CHECK arrays level by level, walks all its conversations through
   them for members and smallest ids, and sums leaves and saved words from the deepest level up.
5. Upper nodes add up what the shards below them found; totals run up the tree by pointer doubling, in as many rounds
   as the logarithm of the deepest upper node.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import WORD_PATTERN, pin

SHARED_TURNS = 4  # a conversation takes fewer than this many first turns from its block's first conversation
BLOCK = 20  # conversations whose ids share a quotient by this
SHARD_ROWS = 1 << 18  # turns of different conversations that one shard holds
BROADCAST_NODES = 200_000  # upper nodes, of some 50 bytes each, that may be broadcast
SEGMENT_IDS = 1_000  # ids joined to one piece of text before a node's digest is run over the pieces

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()
_NODE = ["depth", "x1", "x2"]

Batches = Iterable[pa.RecordBatch]


def _numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _run_through(sums: list[str]) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Number the rows of each conversation within a sorted partition and run ``sums`` on by exclusive or."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count, held = None, 0, {name: np.int64(0) for name in sums}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = _numpy(batch, "conv_id")
            new = np.ones(n, bool)
            new[1:] = conv[1:] != conv[:-1]
            goes_on = last is not None and conv[0] == last
            first = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1
            nth = np.arange(n) - first[run_of]
            if goes_on:
                nth[run_of == 0] += count
            columns = {name: batch.column(name) for name in batch.schema.names if name not in sums}
            for name in sums:
                total = np.bitwise_xor.accumulate(_numpy(batch, name))
                before = np.concatenate([[np.int64(0)], total])[first]
                if goes_on:
                    before[0] ^= held[name]
                found = total ^ before[run_of]
                columns[name] = pa.array(found)
                held[name] = found[-1]
            last, count = conv[-1], int(nth[-1]) + 1
            columns |= {"part": pa.array(np.full(n, part, np.int64)), "nth": pa.array(nth.astype(np.int64))}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _ordered(rows: DataFrame, order: list[Column], sums: list[str], label: str) -> DataFrame:
    """Add ``nth``, a row's place in its conversation from 0, and replace ``sums`` by their running exclusive or.

    The driver sees one row per partition: its first and last conversation and where the last one stands.
    """
    spark = rows.sparkSession
    names = [c for c in rows.columns if c != "turn"]
    sorted_rows = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(F.col("conv_id"), *order, "_tie")
    sorted_rows = sorted_rows.sortWithinPartitions(F.col("conv_id"), *order, "_tie").select(*names)
    fields = [f"{c} long" for c in names if c not in sums] + [f"{c} long" for c in sums] + ["part long", "nth long"]
    numbered = pin(sorted_rows.mapInArrow(_run_through(sums), ", ".join(fields)), label)
    state = F.struct("conv_id", "nth", *sums)
    ends = numbered.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(state).alias("last")).orderBy("part").collect()
    offsets, carried = [], None
    for end in ends:
        found = [end.last[0], end.last[1] + 1, *end.last[2:]]
        if carried and carried[0] == end.first:
            offsets.append((end.part, *carried))
            if end.last[0] == end.first:
                found = [found[0], found[1] + carried[1], *(a ^ b for a, b in zip(found[2:], carried[2:]))]
        carried = found
    if not offsets:
        return numbered.drop("part")
    shown = ", ".join(["part long", "conv_id long", "_n long", *[f"_{name} long" for name in sums]])
    known = numbered.join(F.broadcast(spark.createDataFrame(offsets, shown)), ["part", "conv_id"], "left")
    whole = {"nth": F.col("nth") + F.coalesce("_n", F.lit(0))}
    whole |= {name: F.col(name).bitwiseXOR(F.coalesce(f"_{name}", F.lit(0))) for name in sums}
    return known.withColumns(whole).drop("part", "_n", *[f"_{name}" for name in sums])


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.xxhash64(role, text).alias("k1"),
        F.xxhash64(F.lit(1), text, role).alias("k2"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
    )


def _rebuilt(numbered: DataFrame, convs: DataFrame, shared: int, block: int) -> DataFrame:
    """The turns of the rebuilt conversations: conv_id, depth (from 1), k1, k2, words."""
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(block))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    turn = F.struct("nth", "k1", "k2", "words")
    heads = (
        numbered.where((F.pmod("conv_id", F.lit(block)) == 0) & (F.col("nth") < shared - 1))
        .groupBy(F.col("conv_id").alias("first"))
        .agg(F.sort_array(F.collect_list(turn)).alias("head"))
    )
    plan = (
        convs.select("conv_id", first.alias("first"), taken.cast("int").alias("h"))
        .join(heads, "first", "left")
        .select("conv_id", "h", F.slice("head", F.lit(1), F.col("h")).alias("head"))
    )
    borrowed = plan.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", (F.col("t.nth") + 1).alias("depth"), "t.k1", "t.k2", "t.words"
    )
    own = (
        numbered.join(plan.select("conv_id", "h", F.when(F.col("head").isNull(), 0).otherwise(F.size("head")).alias("n")), "conv_id")
        .where("nth >= h")
        .select("conv_id", (F.col("nth") - F.col("h") + F.col("n") + 1).alias("depth"), "k1", "k2", "words")
    )
    return own.unionByName(borrowed)


def _segments(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Ids of one node joined by commas, some at a time; the rows come sorted by node and id."""
    for batch in batches:
        columns = [_numpy(batch, name) for name in _NODE]
        ids = _numpy(batch, "conv_id")
        new = np.ones(len(ids), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        at = np.arange(len(ids)) - np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
        cut = np.append(np.flatnonzero(at % SEGMENT_IDS == 0), len(ids))
        texts = [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(cut[:-1], cut[1:])]
        held = {name: pa.array(c[cut[:-1]]) for name, c in zip(_NODE, columns)}
        yield pa.RecordBatch.from_pydict(held | {"lowest": pa.array(ids[cut[:-1]]), "ids": pa.array(texts, pa.binary())})


def _digests(batches: Batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's segments; a node's rows stand together and in order."""

    def shown(found: list) -> pa.RecordBatch:
        names, kinds = [*_NODE, "ends_sha256"], [pa.int64()] * 3 + [pa.string()]
        columns = zip(*found) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    node, digest = None, None
    for batch in batches:
        done = []
        for *key, text in zip(*[batch.column(name).to_pylist() for name in [*_NODE, "ids"]]):
            if key == node:
                digest.update(b"," + text)
                continue
            if node is not None:
                done.append((*node, digest.hexdigest()))
            node, digest = key, hashlib.sha256(text)
        yield shown(done)
    if node is not None:
        yield shown([(*node, digest.hexdigest())])


def _ends_sha(ends: DataFrame) -> DataFrame:
    in_order = ends.repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id")
    node = "depth long, x1 long, x2 long"
    pieces = in_order.select(*_NODE, "conv_id").mapInArrow(_segments, f"{node}, lowest long, ids binary")
    # Equal ids in different pieces cannot be: a conversation ends once.
    together = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "lowest")
    return together.mapInArrow(_digests, f"{node}, ends_sha256 string")


class DoubleArray:
    """Transitions of a trie: from state s by symbol c to BASE[s] + c, valid where CHECK there holds s.

    State 0 is the root. A free slot has CHECK -1; BASE may be negative, as only the sum is a place.
    """

    def __init__(self, slots: int) -> None:
        self.base = np.zeros(slots, np.int64)
        self.check = np.full(slots, -1, np.int64)
        self.check[0] = 0
        self.free = 1  # no free slot below

    def _grow(self, slots: int) -> None:
        more = max(slots - len(self.check), 0)
        if more:
            more = max(more, len(self.check) // 2)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _free_slots(self, n: int) -> np.ndarray:
        found = self.free + np.flatnonzero(self.check[self.free :] < 0)
        while len(found) < n:
            self._grow(len(self.check) + n - len(found))
            found = self.free + np.flatnonzero(self.check[self.free :] < 0)
        self.free = int(found[0]) if len(found) else len(self.check)
        return found

    def _fit(self, own: np.ndarray) -> np.ndarray:
        """Slots for all symbols of a state: the first free place for the lowest one where the others are free too."""
        spans, at = own - own[0], self.free
        while at < len(self.check):
            free = at + np.flatnonzero(self.check[at : at + 4096] < 0)
            if at == self.free:
                self.free = int(free[0]) if len(free) else min(at + 4096, len(self.check))
            for place in free.tolist():
                self._grow(place + int(spans[-1]) + 1)
                if (self.check[place + spans] < 0).all():
                    return place + spans
            at += 4096
        at = len(self.check)
        self._grow(at + int(spans[-1]) + 1)
        return at + spans

    def add(self, states: np.ndarray, symbols: np.ndarray) -> None:
        """Place new transitions, sorted by state and symbol, of states that have none yet."""
        if not len(states):
            return
        first = np.flatnonzero(np.concatenate([[True], states[1:] != states[:-1]]))
        size = np.diff(np.append(first, len(states)))
        for at, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
            slots = self._fit(symbols[at : at + n])
            self.base[states[at]] = slots[0] - symbols[at]
            self.check[slots] = states[at]
        single = first[size == 1]
        if len(single):
            slots = self._free_slots(len(single))[: len(single)]
            self.base[states[single]] = slots - symbols[single]
            self.check[slots] = states[single]

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states reached; -1 where there is no such transition."""
        to = self.base[states] + symbols
        inside = (to > 0) & (to < len(self.check))
        found = np.where(inside, to, 0)
        return np.where(inside & (self.check[found] == states), found, -1)


def _dense(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense numbers of equal pairs, in the order of the pairs."""
    order = np.lexsort((two, one))
    new = np.ones(len(one), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    found = np.empty(len(one), np.int64)
    found[order] = np.cumsum(new) - 1
    return found, int(new.sum())


_SHARD_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "is_end boolean, x1 long, x2 long, is_top boolean, p1 long, p2 long"
)


def _shard_nodes(table: pa.Table) -> pa.Table:
    """All nodes of a shard. Rows: conv_id, n, p1, p2 and turns (depth, k1, k2, words, x1, x2 in order of depth)."""
    table = table.combine_chunks()
    turns = table.column("turns").chunk(0)
    starts = turns.offsets.to_numpy()
    flat = turns.values
    field = {name: flat.field(name).to_numpy(zero_copy_only=False) for name in ("depth", "k1", "k2", "words", "x1", "x2")}
    conv, n, p1, p2 = (table.column(name).to_numpy() for name in ("conv_id", "n", "p1", "p2"))
    lengths, starts = np.diff(starts), starts[:-1]
    # Symbols: first those of the tops, named by their whole prefix, then those of the turns below.
    tops, n_tops = _dense(field["x1"][starts], field["x2"][starts])
    below, n_below = _dense(field["k1"], field["k2"])
    trie = DoubleArray(2 * (n_tops + n_below) + 16)

    state = np.zeros(len(conv), np.int64)
    levels: list[np.ndarray] = []
    n_convs = np.zeros(len(trie.check), np.int64)
    lowest = np.full(len(trie.check), np.iinfo(np.int64).max)
    example = np.zeros(len(trie.check), np.int64)  # a turn that leads to the state
    end_of = np.full(len(trie.check), -1, np.int64)
    first_seq = np.zeros(len(trie.check), np.int64)
    for level in range(int(lengths.max())):
        active = np.flatnonzero(lengths > level)
        turn = starts[active] + level
        symbol = tops[active] if level == 0 else below[turn] + n_tops
        order = np.lexsort((symbol, state[active]))
        here, by = state[active][order], symbol[order]
        new = np.ones(len(order), bool)
        new[1:] = (here[1:] != here[:-1]) | (by[1:] != by[:-1])
        trie.add(here[new], by[new])
        grown = len(trie.check) - len(n_convs)
        if grown:
            n_convs = np.append(n_convs, np.zeros(grown, np.int64))
            lowest = np.append(lowest, np.full(grown, np.iinfo(np.int64).max))
            example = np.append(example, np.zeros(grown, np.int64))
            end_of = np.append(end_of, np.full(grown, -1, np.int64))
            first_seq = np.append(first_seq, np.zeros(grown, np.int64))
        reached = trie.step(state[active], symbol)
        np.add.at(n_convs, reached, n[active])
        np.minimum.at(lowest, reached, conv[active])
        example[reached] = turn
        first_seq[reached] = active
        ending = lengths[active] == level + 1
        end_of[reached[ending]] = turn[ending]
        state[active] = reached
        levels.append(np.unique(reached))

    children = np.zeros(len(trie.check), np.int64)
    leaves = np.zeros(len(trie.check), np.int64)
    saved = np.zeros(len(trie.check), np.int64)
    for nodes in reversed(levels):
        leaves[nodes] += children[nodes] == 0
        saved[nodes] += (n_convs[nodes] - 1) * field["words"][example[nodes]]
        parents = trie.check[nodes]
        np.add.at(children, parents, 1)
        np.add.at(leaves, parents, leaves[nodes])
        np.add.at(saved, parents, saved[nodes])

    nodes = np.concatenate(levels)
    top = np.zeros(len(nodes), bool)
    top[: len(levels[0])] = True
    ended = end_of[nodes]
    # An end is named by its own prefix, a top by it too; what the other nodes have there is of no use.
    named = np.where(ended >= 0, ended, example[nodes])
    return pa.table(
        {
            "conv_id": lowest[nodes],
            "depth": field["depth"][example[nodes]],
            "parent_conv_id": pa.array(np.where(top, 0, lowest[trie.check[nodes]]), mask=top),
            "n_convs": n_convs[nodes],
            "n_children": children[nodes],
            "n_leaves": leaves[nodes],
            "saved_tokens": saved[nodes],
            "is_end": ended >= 0,
            "x1": field["x1"][named],
            "x2": field["x2"][named],
            "is_top": top,
            "p1": p1[first_seq[nodes]],
            "p2": p2[first_seq[nodes]],
        }
    )


def _lifted(upper: DataFrame, deepest: int) -> DataFrame:
    """Add up leaves and saved words of all upper nodes below, by pointer doubling over the parents."""
    for _ in range(math.ceil(math.log2(deepest + 1)) if deepest else 0):
        up = upper.groupBy("a_depth", "a1", "a2").agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        up = up.where("a_depth is not null").select(
            F.col("a_depth").alias("depth"), F.col("a1").alias("x1"), F.col("a2").alias("x2"), "_leaves", "_saved"
        )
        jump = upper.select(
            *[F.col(c).alias(a) for c, a in zip(_NODE, ["a_depth", "a1", "a2"])],
            *[F.col(a).alias(f"_{a}") for a in ("a_depth", "a1", "a2")],
        )
        more = upper.join(up, _NODE, "left").join(jump, ["a_depth", "a1", "a2"], "left")
        same = [c for c in upper.columns if c not in ("a_depth", "a1", "a2", "leaves", "saved")]
        more = more.select(
            *same,
            (F.col("leaves") + F.coalesce("_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved"),
            *[F.col(f"_{a}").alias(a) for a in ("a_depth", "a1", "a2")],
        )
        upper = pin(more, "trie-upper")
    return upper


def prefix_trie(
    conversations: DataFrame, shared: int = SHARED_TURNS, block: int = BLOCK, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role, text; other columns are ignored, whatever their names. Turns are ordered
    by ``turn``, null first; turns with the same number by digests of role and text, so equal rows are two equal turns.
    Null roles and texts are empty. Rows without a conv_id belong to no conversation and are left out. An empty table
    has no node, not even the root. Turns and prefixes are told apart by 128 bits of digest.
    """
    turns = pin(_turns(conversations), "trie-turns")
    numbered = _ordered(turns, [F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")], [], "trie-numbered")
    convs = pin(turns.select("conv_id").distinct(), "trie-convs")
    rebuilt = _rebuilt(numbered, convs, shared, block).withColumns(
        {"x1": F.xxhash64("depth", "k1", "k2"), "x2": F.xxhash64(F.lit(2), "k2", "depth", "k1")}
    )
    rows = _ordered(pin(rebuilt, "trie-rebuilt"), [F.col("depth")], ["x1", "x2"], "trie-prefixes").drop("nth")

    ended = rows.groupBy("conv_id").agg(F.max(F.struct(*_NODE)).alias("end"))
    ends = pin(
        convs.join(ended, "conv_id", "left").select(
            "conv_id", *[F.coalesce(F.col(f"end.{c}"), F.lit(0).cast("long")).alias(c) for c in _NODE]
        ),
        "trie-ends",
    )
    different = pin(
        ends.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")), "trie-different"
    )
    standing = different.where("depth > 0").select("conv_id", "n", F.col("depth").alias("length"))
    own = F.xxhash64("depth", "k1", "k2"), F.xxhash64(F.lit(2), "k2", "depth", "k1")
    rows = rows.join(standing, "conv_id").withColumns(
        {"p1": F.col("x1").bitwiseXOR(own[0]), "p2": F.col("x2").bitwiseXOR(own[1])}
    )
    rows = pin(rows, "trie-rows")

    upper = (
        rows.groupBy(*_NODE)
        .agg(
            F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n").alias("n_convs"),
            F.first("words").alias("words"),
            F.first("p1").alias("a1"),
            F.first("p2").alias("a2"),
        )
        .where(F.col("weight") > shard_rows)
        .withColumn("a_depth", F.col("depth") - 1)
        .drop("weight")
    )
    upper = pin(upper, "trie-heavy")
    heavy = upper.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("depth"), F.lit(0)).alias("deepest")).first()

    light = rows
    if heavy.n:
        marks = upper.select(*_NODE)
        marks = F.broadcast(marks) if heavy.n <= BROADCAST_NODES else marks
        light = rows.join(marks, _NODE, "left_anti")
    total = light.count()
    shards = max(1, math.ceil(total / shard_rows))
    turn = F.struct("depth", "k1", "k2", "words", "x1", "x2")
    # What is left of a conversation lies below its top, which has at most shard_rows turns.
    below = light.groupBy("conv_id", "n").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"),
        F.min(F.struct("depth", "p1", "p2")).alias("above"),
    )
    top = F.col("turns")[0]
    below = below.select(
        "conv_id",
        "n",
        F.col("above.p1").alias("p1"),
        F.col("above.p2").alias("p2"),
        "turns",
        F.pmod(F.xxhash64(top["depth"], top["x1"], top["x2"]), F.lit(shards)).alias("shard"),
    )
    nodes = below.repartition(shards, "shard").groupBy("shard").applyInArrow(_shard_nodes, _SHARD_NODES)
    nodes = pin(nodes, "trie-nodes")

    tops = (
        nodes.where("is_top")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
        .agg(F.count(F.lit(1)).alias("tops"), F.sum("n_leaves").alias("top_leaves"), F.sum("saved_tokens").alias("top_saved"))
    )
    zero = F.lit(0).cast("long")
    root = ends.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        *[zero.alias(c) for c in _NODE],
        "conv_id",
        "n_convs",
        zero.alias("words"),
        *[F.lit(None).cast("long").alias(c) for c in ("a1", "a2", "a_depth")],
    )
    upper = upper.unionByName(root)
    sons = upper.groupBy(F.col("a_depth").alias("depth"), F.col("a1").alias("x1"), F.col("a2").alias("x2"))
    sons = sons.agg(F.count(F.lit(1)).alias("sons")).where("depth is not null")
    upper = upper.join(tops, _NODE, "left").join(sons, _NODE, "left")
    children = F.coalesce("tops", zero) + F.coalesce("sons", zero)
    upper = upper.select(
        *_NODE,
        "conv_id",
        "n_convs",
        children.alias("n_children"),
        # Only the root can be without children here: an upper node has more than one turn below it.
        F.when(children == 0, 1).otherwise(F.coalesce("top_leaves", zero)).cast("long").alias("leaves"),
        (F.coalesce("top_saved", zero) + (F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        "a_depth",
        "a1",
        "a2",
        *[F.col(a).alias(f"parent_{c}") for c, a in zip(_NODE, ("a_depth", "a1", "a2"))],
    )
    upper = _lifted(pin(upper, "trie-upper"), heavy.deepest)

    measures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    above = upper.select(*[F.col(c).alias(f"parent_{c}") for c in _NODE], F.col("conv_id").alias("_above"))
    above = F.broadcast(above) if heavy.n <= BROADCAST_NODES else above
    of_upper = upper.select(
        "conv_id",
        *_NODE,
        *[f"parent_{c}" for c in _NODE],
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.lit(True).alias("is_end"),  # not every one is; the join tells
    )
    of_tops = nodes.where("is_top").select(
        "conv_id",
        *_NODE,
        (F.col("depth") - 1).alias("parent_depth"),
        F.col("p1").alias("parent_x1"),
        F.col("p2").alias("parent_x2"),
        *measures,
        "is_end",
    )
    joined = of_upper.unionByName(of_tops).join(above, [f"parent_{c}" for c in _NODE], "left")
    found = joined.select("conv_id", *_NODE, F.col("_above").alias("parent_conv_id"), *measures, "is_end").unionByName(
        nodes.where("not is_top").select("conv_id", *_NODE, "parent_conv_id", *measures, "is_end")
    )
    known = found.where("is_end").join(_ends_sha(ends), _NODE, "left")
    other = found.where("not is_end").withColumn("ends_sha256", F.lit(None).cast("string"))
    result = known.unionByName(other)
    return result.select(
        "conv_id", "depth", "parent_conv_id", *measures, F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256")
    )
