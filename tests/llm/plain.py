"""The contracts' results by plain single-threaded code, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

from evenkeel.llm.tokens import TOKENIZER

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2):
    """Sources' targets by sharing out the excess round by round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, found = share * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * unit >= most * sizes[s]}
        if not over:
            return found | {s: weight[s] * unit for s in free}
        for s in over:
            found[s] = most * sizes[s]
            left -= found[s]
        free -= over
    return found


def token_ids(texts, plain=False):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = plain
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def pieces(doc_id, ids, capacity=2048):
    ids = [*ids, 0]
    for number, at in enumerate(range(0, len(ids), capacity)):
        part = ids[at : at + capacity]
        yield (doc_id, number, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))


def base_statistics(text):
    own = words(text)
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = defaultdict(list)
    for i in range(len(own) - 7):
        windows[tuple(own[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (
        len(own),
        sum(map(len, own)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def shingles(text, width=4):
    own = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not own:
        return frozenset()
    if len(own) < width:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + width]) for i in range(len(own) - width + 1))


def groups(docs: pd.DataFrame, percent=85):
    """doc_id -> (n_shingles, smallest doc_id reachable)."""
    sets = {d: shingles(t) for d, t in zip(docs.doc_id, docs.text)}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = defaultdict(list)
    for d, own in sets.items():
        for s in own:
            lists[s].append(d)
    common = Counter((a, b) for at in lists.values() for i, a in enumerate(at) for b in at[i + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def stripped(docs: pd.DataFrame, width=20):
    """doc_id -> (n_words, n_removed, sha256 of the kept words)."""
    seen, found = set(), {}
    for doc_id, text in sorted(zip(docs.doc_id, docs.text)):
        own = words(text)
        gone = set()
        for i in range(len(own) - width + 1):
            window = tuple(own[i : i + width])
            if window in seen:
                gone.update(range(i, i + width))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        found[doc_id] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def nearest(ids, vectors, query, k=10):
    score = np.sqrt(((vectors - vectors[query]) ** 2).sum(1))
    score[query] = math.inf
    best = np.lexsort((ids, score))[:k]
    return [(int(ids[b]), float(score[b])) for b in best if score[b] < math.inf]
