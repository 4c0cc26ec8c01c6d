"""The trie of rebuilt conversations against plain code, whole tables against SQL, and its double array."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from evenkeel.llm.expected import EXPECTED
from evenkeel.llm.prefix_trie import DoubleArray, prefix_trie
from evenkeel.llm.queries import QUERIES
from tests.oracle import connect, differences

COLUMNS = "conv_id long, turn long, role string, text string"


def nodes(rows):
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, sha) of every node."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(found, key=lambda t: t[:2])] for c, found in turns.items()}
    rebuilt = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = (*own.get(c - c % 20, [])[:h], *found[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    found = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in own if len(rebuilt[c]) == len(path))
        found.append(
            (
                min(own),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(own),
                sum(len(p) == len(path) + 1 for p in below),
                sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in members) for p in below),
                sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=str)


def found_nodes(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def some_rows(seed, convs, texts, most):
    rng = random.Random(seed)
    rows = []
    for conv in convs:
        for turn in range(rng.randint(1, most)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(texts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_rows", [1 << 18, 12, 1])
def test_against_plain_code(spark, shard_rows):
    rows = some_rows(3, range(-5, 90), ["a b", "c", "", "d e f"], 7)
    rows += [(conv, t, "user", f"hot {t}") for conv in (100, 120, 140, 160, 180) for t in range(9)]
    got = prefix_trie(spark.createDataFrame(rows, COLUMNS).repartition(5), shard_rows=shard_rows)
    assert found_nodes(got) == nodes(rows)


def test_one_conversation_over_many_partitions(spark):
    rows = [(7, t, "user", f"turn {t}") for t in range(400)] + some_rows(4, range(20, 40), ["x", "y y"], 3)
    assert found_nodes(prefix_trie(spark.createDataFrame(rows, COLUMNS), shard_rows=50)) == nodes(rows)


def test_nulls_empty_texts_and_repeats(spark):
    rows = [
        (None, 0, "user", "no conversation"),
        (1, None, None, None),
        (1, 0, "", "later"),
        (2, 5, "user", "one"),
        (2, 5, "user", "one"),
        (20, 0, "user", ""),
        (21, 1, "user", "x" * 100_000 + " y"),
        (40, 0, "user", "same"),
        (41, 0, "user", "same"),
    ]
    assert found_nodes(prefix_trie(spark.createDataFrame(rows, COLUMNS))) == nodes(rows)


def test_turnless_conversations_and_empty_table(spark):
    # 41 and 57 keep no turn: all their own go, and no conversation 40 is there.
    gone = [c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 0, "user", "short") for c in gone]
    assert len(gone) == 2 and found_nodes(prefix_trie(spark.createDataFrame(rows, COLUMNS))) == nodes(rows)
    empty = prefix_trie(spark.createDataFrame([], COLUMNS))
    assert empty.collect() == [] and len(empty.columns) == 8


def test_other_columns_may_clash(spark):
    rows = some_rows(5, range(12), ["a", "b b"], 4)
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 as depth", "2 as k1", "'x' as nth", "3 as `a.b`", "4 as part")
    assert found_nodes(prefix_trie(df)) == nodes(rows)


def test_double_array_finds_what_was_put_in():
    rng = np.random.default_rng(6)
    trie, reached, known = DoubleArray(4), [0], {}
    for _ in range(6):
        states = np.array(sorted(rng.choice(reached, min(len(reached), 20), replace=False)))
        states = states[[s not in {k for k, _ in known} for s in states.tolist()]]
        wanted = [(s, c) for s in states.tolist() for c in sorted(rng.choice(300, rng.integers(1, 9), replace=False).tolist())]
        if not wanted:
            continue
        a, b = np.array(wanted).T
        trie.add(a, b)
        to = trie.step(a, b)
        assert len(set(to.tolist())) == len(to) and (to > 0).all() and not set(to.tolist()) & set(known.values())
        known |= dict(zip(wanted, to.tolist()))
        reached += to.tolist()
    keys = np.array(list(known)).T
    assert (trie.step(*keys) == list(known.values())).all()
    missing = np.array([(s, c) for s in set(keys[0].tolist()) for c in range(300) if (s, c) not in known]).T
    assert (trie.step(*missing) == -1).all()


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_whole_table_against_sql(spark, sf):
    path = f"/root/testdata/sf{sf}"
    assert differences(QUERIES["op12_prefix_trie"](spark, path), connect(path), EXPECTED["op12_prefix_trie"]) == []
