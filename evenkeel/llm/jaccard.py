"""N-gram Jaccard join by vertical partitioning: groups of documents whose shingle sets are alike.

1. Every document becomes a set of 64-bit shingle hashes. Documents with equal sets share one set digest, so thousands
   of copies count as one set from here on.
2. The global n-gram order is cut into fragments. Each fragment counts in how many sets an n-gram occurs; only n-grams
   of two or more sets can overlap. A set with too few of them links with nothing and is done.
3. What is left is a set's *signature*: its shared n-grams, rarest first. Two linked sets share an n-gram among the
   first few (prefix filter), which gives candidates. To avoid all pairs of a group, each n-gram's sets are first held
   against one hub; linked sets merge into components; then against further hubs; at last every remaining pair of
   sets of different components that shares a prefix n-gram and passes the length and position filters.
4. Candidates are decided exactly: partial overlaps are counted in each vertical fragment and summed per pair.

Nothing is capped. Hashes have 64 bits (shipped as 48 bits plus the fragment in step 2).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from evenkeel.llm.common import by_bytes, chunks, hash_words, pin, rolling_hash, runs, scrambled, text_bytes, tidy, total_bytes
from evenkeel.llm.substring import fragments_for

SHINGLE = 4
PERCENT = 85
FRAGMENT_BYTES = 12 << 20
CHUNK_BYTES = 2 << 20
VERTICAL_BITS = 3  # the order of shared n-grams is cut into 2^bits fragments for the overlaps
HUB_ROUNDS = 3

_BASE = 0xD6E8FEB86659FD93
_PACKED = "frag long, sets binary, sizes binary, counts binary, hashes binary"


def least_overlap(size: int, percent: int) -> int:
    return -(-size * percent // 100)


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a shorter text is one n-gram, no words give none."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    return np.unique(rolling_hash(hash_words(words), width, _BASE))


def set_digest(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def document_sets(docs: DataFrame, width: int = SHINGLE, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_shingles, set_id) and the ``carried`` columns per row; ``set_id`` is null for a document without words."""

    @tidy
    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "body", CHUNK_BYTES):
            sizes, ids = [], []
            for text in batch["body"].to_pylist():
                found = shingle_set(text, width)
                sizes.append(len(found))
                ids.append(set_digest(found) if len(found) else None)
            yield pa.record_batch(
                [
                    batch["doc_id"].combine_chunks(),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    *[batch[c].combine_chunks() for c in carried],
                ],
                ["doc_id", "n_shingles", "set_id", *carried],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"), *carried)
    own = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried]
    return rows.mapInArrow(digest, ", ".join(["doc_id long, n_shingles long, set_id long", *own]))


@tidy
def _packed(batches: Iterable[pd.DataFrame], width: int, fragments: int) -> Iterator[pd.DataFrame]:
    for rows in chunks(batches, "body", CHUNK_BYTES):
        sets = {}
        for text in rows["body"]:
            found = shingle_set(text, width)
            if len(found):
                sets.setdefault(set_digest(found), found)
        if not sets:
            continue
        ids = np.fromiter(sets.keys(), np.int64, len(sets))
        sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
        hashes, of_set = np.concatenate(list(sets.values())), np.repeat(np.arange(len(ids)), sizes)
        frag = ((hashes >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)  # the top bits, which are not sent
        order = np.argsort(frag.astype(np.uint16 if fragments <= 1 << 16 else np.uint64), kind="stable")
        frag, hashes, of_set = frag[order].astype(np.int64), hashes[order], of_set[order]
        out = []
        for at, size in zip(*runs(frag)):
            head, counts = runs(of_set[at : at + size])
            own = of_set[at + head]
            low = np.ascontiguousarray(hashes[at : at + size].view(np.uint8).reshape(-1, 8)[:, :6])
            out.append(
                (
                    int(frag[at]),
                    ids[own].tobytes(),
                    sizes[own].astype(np.uint32).tobytes(),
                    counts.astype(np.uint32).tobytes(),
                    low.tobytes(),
                )
            )
        yield pd.DataFrame(out, columns=[x.split()[0] for x in _PACKED.split(", ")])


def _shared(group: pd.DataFrame) -> pd.DataFrame:
    """The n-grams of one fragment that occur in two or more sets, by set."""
    counts = np.frombuffer(b"".join(group["counts"]), np.uint32)
    ids = np.repeat(np.frombuffer(b"".join(group["sets"]), np.int64), counts)
    sizes = np.repeat(np.frombuffer(b"".join(group["sizes"]), np.uint32), counts)
    low = np.frombuffer(b"".join(group["hashes"]), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, :6] = low
    hashes = wide.view(np.uint64)[:, 0]
    order = np.argsort(hashes, kind="stable")
    size = runs(hashes[order])[1]
    order = order[np.repeat(size, size) > 1]
    order = order[np.lexsort((ids[order], hashes[order]))]
    new = np.ones(len(order), bool)  # a set may come from several chunks
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    order = order[new]
    size = runs(hashes[order])[1]
    often = np.repeat(size, size)
    order, often = order[often > 1], often[often > 1].astype(np.int32)
    frag = np.uint64(group["frag"].iloc[0] if len(group) else 0)
    tokens = scrambled(hashes[order] ^ scrambled(np.full(len(order), frag)))
    by_set = np.argsort(ids[order], kind="stable")
    order, often, tokens = order[by_set], often[by_set], tokens[by_set]
    head, counts = runs(ids[order])
    return pd.DataFrame(
        {
            "set_id": ids[order][head],
            "size": sizes[order][head].astype(np.int64),
            "n": counts,
            "tokens": [x.tobytes() for x in np.split(tokens, head[1:])] if len(head) else [],
            "often": [x.tobytes() for x in np.split(often, head[1:])] if len(head) else [],
        }
    )


def _signature(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens, prefixes = [], []
        for size, n, parts in zip(batch["size"].to_pylist(), batch["n"].to_pylist(), batch["parts"].to_pylist()):
            token = np.frombuffer(b"".join(p["tokens"] for p in parts), np.uint64)
            often = np.frombuffer(b"".join(p["often"] for p in parts), np.int32)
            tokens.append(token[np.lexsort((token, often))].view(np.int64))
            prefixes.append(size - least_overlap(size, percent) + 1 - (size - n))
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in tokens])]).astype(np.int32)
        flat = pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64), pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(offsets), flat)
        yield pa.record_batch(
            [batch["set_id"], batch["size"], batch["n"], pa.array(prefixes, pa.int32()), lists],
            ["set_id", "size", "n", "prefix", "tokens"],
        )


def signatures(docs: DataFrame, width: int, percent: int, fragment_bytes: int = FRAGMENT_BYTES) -> DataFrame:
    """Sets that may link: set_id, size, n (shared n-grams), prefix, tokens (the shared n-grams, rarest first)."""
    fragments = fragments_for(total_bytes(docs), fragment_bytes)
    body = docs.select(text_bytes().alias("body"))
    packed = body.mapInPandas(lambda batches: _packed(batches, width, fragments), _PACKED)
    shared = packed.groupBy("frag").applyInPandas(_shared, "set_id long, size long, n long, tokens binary, often binary")
    kept = (
        shared.groupBy("set_id")
        .agg(F.first("size").alias("size"), F.sum("n").alias("n"), F.collect_list(F.struct("tokens", "often")).alias("parts"))
        .where(F.col("n") * 100 >= F.col("size") * percent)
    )
    return kept.mapInArrow(
        lambda batches: _signature(batches, percent), "set_id long, size long, n long, prefix int, tokens array<long>"
    )


def _alike(overlap: Column, left: Column, right: Column, percent: int) -> Column:
    return overlap * 100 >= (left + right - overlap) * percent


def linked_pairs(pairs: DataFrame, vertical: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike: partial overlaps by vertical fragment, summed per pair."""
    left = vertical.select(F.col("set_id").alias("a"), F.col("size").alias("size_a"), "cut", F.col("tokens").alias("of_a"))
    right = vertical.select(F.col("set_id").alias("b"), F.col("size").alias("size_b"), "cut", F.col("tokens").alias("of_b"))
    partial = pairs.join(left, "a").join(right, ["b", "cut"])
    partial = partial.select("a", "b", "size_a", "size_b", F.size(F.array_intersect("of_a", "of_b")).alias("part"))
    overlap = partial.groupBy("a", "b", "size_a", "size_b").agg(F.sum("part").alias("overlap"))
    return overlap.where(_alike(F.col("overlap"), F.col("size_a"), F.col("size_b"), percent)).select("a", "b")


def _measured(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """Pin, and return the number of rows and an order-free checksum of them."""
    seen = Observation()
    value = F.shiftright(F.xxhash64(*df.columns), 16)
    kept = pin(df.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(value), F.lit(0)).alias("mark")), label)
    found = seen.get
    return kept, found["n"], found["mark"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for every node of an edge (a, b).

    Large-star and small-star steps in turn until nothing changes; every step is joins and minima by node.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges, n, mark = _measured(edges, "edges")
    while n:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, n_after, mark_after = _measured(small.union(low).distinct(), "edges")
        edges, changed = after, (n_after, mark_after) != (n, mark)
        n, mark = n_after, mark_after
        if not changed:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _merged(links: list[DataFrame]) -> DataFrame:
    every = links[0]
    for more in links[1:]:
        every = every.union(more)
    return pin(components(every), "components")


def _labelled(postings: DataFrame, roots: DataFrame) -> DataFrame:
    return postings.join(roots, postings.set_id == roots.node, "left").select(
        *[postings[c] for c in postings.columns], F.coalesce("root", "set_id").alias("root")
    )


def _ordered(first: Column, second: Column) -> list[Column]:
    return [F.least(first, second).alias("a"), F.greatest(first, second).alias("b")]


def set_components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(node, root) for every set that links with another one."""
    sets = pin(signatures(docs, width, percent), "signatures")
    cut = F.shiftrightunsigned("token", 64 - VERTICAL_BITS)
    vertical = (
        sets.select("set_id", "size", F.explode("tokens").alias("token"))
        .groupBy("set_id", "size", cut.alias("cut"))
        .agg(F.collect_list("token").alias("tokens"))
    )
    vertical = pin(vertical, "vertical")
    listed = sets.select(
        "set_id", "size", (F.col("size") - F.col("n")).alias("rare"), F.posexplode(F.slice("tokens", 1, F.col("prefix")))
    ).withColumnsRenamed({"col": "token"})
    several = listed.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("token")
    postings = pin(listed.join(several, "token"), "postings")
    near = F.least("size", "hub.size") * 100 >= F.greatest("size", "hub.size") * percent

    links, tried = [], []
    roots = postings.select(F.col("set_id").alias("node"), F.col("set_id").alias("root")).limit(0)
    for number in range(HUB_ROUNDS):
        now = _labelled(postings, roots)
        # The first hub is the set with the fewest n-grams of its own; later ones are drawn anew.
        rank = F.col("rare") if number == 0 else F.xxhash64("set_id", F.lit(number))
        hubs = now.groupBy("token").agg(F.min(F.struct(rank.alias("rank"), "set_id", "size", "root")).alias("hub"))
        pairs = now.join(hubs, "token").where(F.col("root") != F.col("hub.root")).where(near)
        pairs = pairs.select(*_ordered(F.col("set_id"), F.col("hub.set_id"))).distinct()
        for old in tried:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        tried.append(pin(pairs, "pairs"))
        links.append(pin(linked_pairs(tried[-1], vertical, percent), "links"))
        roots = _merged(links)

    now = _labelled(postings, roots)
    one, two = now.alias("one"), now.alias("two")
    size_1, size_2 = F.col("one.size"), F.col("two.size")
    # If this is the pair's first common n-gram, no more than what follows it can be shared.
    rest = 1 + F.least(*[F.col(f"{s}.size") - F.col(f"{s}.rare") - F.col(f"{s}.pos") - 1 for s in ("one", "two")])
    crossing = one.join(
        two,
        (F.col("one.token") == F.col("two.token"))
        & (F.col("one.set_id") < F.col("two.set_id"))
        & (F.col("one.root") != F.col("two.root"))
        & (F.least(size_1, size_2) * 100 >= F.greatest(size_1, size_2) * percent)
        & _alike(rest, size_1, size_2, percent),
    )
    pairs = crossing.select(F.col("one.set_id").alias("a"), F.col("two.set_id").alias("b")).distinct()
    for old in tried:
        pairs = pairs.join(old, ["a", "b"], "left_anti")
    links.append(pin(linked_pairs(pin(pairs, "pairs"), vertical, percent), "links"))
    return _merged(links)


def first_of_groups(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(same, row) of one row per group of ``docs`` (doc_id, text, and the texts same and row, never null): the smallest
    doc_id, nulls last, then the smallest ``same`` and ``row``. Rows without words are one group per ``same``."""
    members = pin(document_sets(docs, width, ("same", "row")), "sets")
    roots = set_components(docs, width, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "same", "row")).alias("first")
    # By set before by group, so that copies meet in no join.
    sets = members.groupBy("set_id", F.when(F.col("set_id").isNull(), F.col("same")).alias("wordless")).agg(first)
    grouped = sets.join(roots, sets.set_id == roots.node, "left")
    least = grouped.groupBy(F.coalesce("root", "set_id").alias("root"), "wordless").agg(F.min("first").alias("first"))
    return least.select("first.same", "first.row")


def jaccard_groups(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id long, text string): doc_id, n_shingles, component_id.

    A document's set holds the distinct ``width``-word n-grams of its text with A-Z lower-cased; a shorter text is one
    n-gram. Two documents link when 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest doc_id
    that links lead to, the own one included.

    Documents without words or with a null text have an empty set, link with nothing and keep their own doc_id. Rows
    with a null doc_id take part; they get the smallest doc_id of their group, null if there is none. Repeated rows
    have equal sets and so share a component. An empty table gives an empty result; other columns are not read.
    """
    members = pin(document_sets(docs, width), "sets")
    roots = set_components(docs, width, percent)
    least = members.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    sets = least.join(roots, least.set_id == roots.node, "left").select(
        F.col("set_id").alias("_set"), "least", F.coalesce("root", "set_id").alias("root")
    )
    groups = sets.groupBy("root").agg(F.min("least").alias("component"))
    named = sets.join(groups, "root").select("_set", "component")
    return members.join(named, members.set_id == named._set, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )
