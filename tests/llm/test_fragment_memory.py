"""What a fragment of windows takes in a worker, and that it finds the same repeats."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa

from evenkeel.llm import substring

WIDTH = 20


def _fragment(texts):
    rows = pa.record_batch({"id": np.arange(len(texts)), "body": pa.array(texts, pa.binary())})
    parts = [rows.slice(at, 50) for at in range(0, len(texts), 50)]
    return pd.concat([out.to_pandas() for part in parts for out in substring._packed([part], WIDTH, 1)], ignore_index=True)


def test_places_are_looked_up_for_repeated_windows_only():
    rng = np.random.default_rng(3)
    texts = [b" ".join(b"%d" % word for word in rng.integers(0, 1 << 40, 1000)) for _ in range(200)]
    texts[150] = b"a b " + texts[10]  # all windows of one text again, two words later
    group = _fragment(texts)
    windows = sum(map(len, group["hashes"])) // 8
    tracemalloc.start()
    found = substring._fragment_repeats(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found["id"].tolist() == [150]
    assert np.frombuffer(found["starts"][0], np.int32).tolist() == list(range(2, 1000 - WIDTH + 3))
    assert peak < 40 * windows  # the hashes, their order and the sort's own space


def test_a_fragment_of_repeats_only():
    text = b" ".join(b"%d" % word for word in range(100))
    group = _fragment([text] * 120)
    found = substring._fragment_repeats(group)
    # Repeats within a chunk of fifty are known there; across chunks the first text of each later one is left.
    assert found["id"].tolist() == [50, 100]
    assert all(np.frombuffer(x, np.int32).tolist() == list(range(100 - WIDTH + 1)) for x in found["starts"])


def test_a_batch_is_cut_before_it_becomes_python_objects(monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 20_000)
    texts = [b"%d " % n * 200 for n in range(2000)]
    batch = pa.record_batch({"id": np.arange(len(texts)), "body": pa.array(texts, pa.binary())})
    for task in (lambda: substring._packed([batch], WIDTH, 1), lambda: substring._known_repeats([batch], WIDTH)):
        tracemalloc.start()
        chunks = sum(1 for _ in task())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert chunks >= 40
        assert peak < sum(map(len, texts))


def test_texts_without_windows_and_null_texts():
    batch = pa.record_batch({"id": pa.array([1, 2, 3]), "body": pa.array([None, b"", b"a b c"], pa.binary())})
    assert [out.num_rows for out in substring._packed([batch], WIDTH, 4)] == [0]
    assert [out.num_rows for out in substring._known_repeats([batch], WIDTH)] == [0]
