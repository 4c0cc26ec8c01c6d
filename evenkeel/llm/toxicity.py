"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the presence of its words, word pairs and pairs with one word between, hashed to 2^20 places.
FTRL-proximal learns with a rate per coordinate and an L1 term that leaves most weights at exactly zero, so the model
is a small sparse vector (at most 2^20 weights), broadcast to the scoring tasks. It is fitted on a bounded sample of
labelled rows: the first by a hash of doc_id, at most ``most_rows`` rows and ``most_bytes`` bytes of text; a text
that would take the sum above that is passed over. Every whole text is scored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import by_bytes, hash_words, scrambled, tidy

BITS = 20
MOST_ROWS = 20_000
MOST_BYTES = 32 << 20
CHUNK_BYTES = 2 << 20  # text scored together
THRESHOLD = 0.7
EPOCHS = 6

_WORD = re.compile(r"[^\W\d_]+")
_PAIR, _SKIP = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1342543DE82EF95)


@dataclass(frozen=True)
class Ftrl:
    """FTRL-proximal: rate ``alpha / (beta + sqrt(sum of squared gradients))`` per coordinate, L1 and L2 terms."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 0.1
    epochs: int = EPOCHS

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, places: int = 1 << BITS) -> tuple[np.ndarray, float]:
        """Weights and bias from each row's feature places. Rows are taken in the given order, ``epochs`` times."""
        z, n = np.zeros(places + 1), np.zeros(places + 1)
        bias = np.array([places])  # never shrunk
        for _ in range(self.epochs):
            for own, label in zip(rows, labels):
                at = np.concatenate([own, bias])
                weight = self._weights(z[at], n[at], own=len(own))
                error = 1 / (1 + np.exp(-np.clip(weight.sum(), -35, 35))) - label
                grown = n[at] + error * error
                z[at] += error - (np.sqrt(grown) - np.sqrt(n[at])) / self.alpha * weight
                n[at] = grown
        weights = self._weights(z, n, own=places)
        return weights[:places], float(weights[places])

    def _weights(self, z: np.ndarray, n: np.ndarray, own: int) -> np.ndarray:
        l1 = np.zeros(len(z))
        l1[:own] = self.l1
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Places of the text's words, neighbouring pairs and pairs with one word between; repeats included."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.zeros(0, np.int64)
    single = hash_words([word.encode("utf-8", "replace") for word in words])
    pairs = scrambled(single[:-1] * _PAIR + single[1:])
    skips = scrambled(single[:-2] * _SKIP + single[2:])
    return (np.concatenate([scrambled(single), pairs, skips]) >> np.uint64(64 - bits)).astype(np.int64)


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Non-zero weights by place, and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        every = np.zeros(1 << self.bits)
        every[self.places] = self.weights
        return every


def training_rows(docs: DataFrame, labels: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    """(order, doc_id, toxic, text) of the bounded sample; a text that does not fit any more is left out, not what follows."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("_labelled"))
    marks = marks.agg(F.max("toxic").cast("int").alias("toxic"))
    usable = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.col("doc_id").cast("long"), F.lit("toxic")).alias("order")
    )
    sizes = usable.select("order", "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    sizes = sizes.join(marks, F.col("doc_id") == F.col("_labelled")).groupBy("order", "doc_id", "bytes").agg(F.count(F.lit(1)).alias("n"))
    chosen: list[tuple[int, int, int]] = []
    rows, left, total = most_rows, most_bytes, sizes.count()
    # The hashes are uniform, so a range of them holds about its share of the rows: each round takes the next range,
    # with a little more than is still wanted, and no task sends more than its part of that.
    low, past = -(1 << 63), 1 << 63
    while rows > 0 and low < past and total:
        high = min(past, low + math.ceil((1 << 64) * (rows + 6 * math.isqrt(rows) + 20) / total))
        # Texts longer than what is left never fit.
        within = (F.col("order") >= low) & (F.col("order") <= high - 1) & (F.col("bytes") <= left)
        for row in sorted(sizes.where(within).collect(), key=lambda r: (r.order, r.doc_id, r.bytes)):
            fit = min(row.n, rows, left // row.bytes if row.bytes else rows)
            if fit:
                chosen.append((row.doc_id, row.bytes, fit))
                rows, left = rows - fit, left - fit * row.bytes
        low = high
    picked = docs.sparkSession.createDataFrame(chosen, "_doc long, _bytes long, _fit long")
    same = (F.col("doc_id") == F.col("_doc")) & (F.coalesce(F.octet_length("text"), F.lit(0)) == F.col("_bytes"))
    taken = usable.join(F.broadcast(picked), same)
    nth = F.row_number().over(Window.partitionBy("_doc", "_bytes").orderBy(F.xxhash64("text")))
    taken = taken.withColumn("_nth", nth).where("_nth <= _fit")
    return taken.join(marks, F.col("doc_id") == F.col("_labelled")).select("order", "doc_id", "toxic", "text")


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, ftrl: Ftrl = Ftrl()
) -> Model:
    """Fit on labelled rows outside the held-out third. Rows are visited in the order of a hash, so reruns agree."""

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(features(text)).astype(np.uint32).tobytes() for text in batch["text"].to_pylist()]
            yield pa.record_batch(
                [batch["order"], batch["doc_id"], batch["toxic"], pa.array(found, pa.binary())],
                ["order", "doc_id", "toxic", "places"],
            )

    rows = training_rows(docs, labels, most_rows, most_bytes)
    sample = rows.mapInArrow(places, "order long, doc_id long, toxic int, places binary").toPandas()
    sample = sample.sort_values(["order", "doc_id", "places"], ignore_index=True)
    own = [np.frombuffer(x, np.uint32).astype(np.int64) for x in sample["places"]]
    weights, bias = ftrl.fit(own, sample["toxic"].to_numpy(float))
    kept = np.flatnonzero(weights)
    return Model(kept, weights[kept], bias)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) per row of ``docs`` (doc_id, text); a text without words gets the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = shared.value.dense()
        for batch in by_bytes(batches, "text", CHUNK_BYTES):
            scores = []
            for text in batch["text"].to_pylist():
                at = features(text, shared.value.bits)
                hits = np.unique(at[dense[at] != 0])
                scores.append(1 / (1 + np.exp(-np.clip(dense[hits].sum() + shared.value.bias, -35, 35))))
            yield pa.record_batch([batch["doc_id"].combine_chunks(), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(score, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 from a score of 0.7 on).

    Rows whose crc32 of doc_id modulo 3 is 1 are held out from fitting. Null and empty texts are scored like texts
    without words; null ids are scored and never learned from; a doc_id labelled twice is toxic if one label says so.
    Without labels every score is 0.5. Repeated rows give repeated rows, an empty table an empty result.
    """
    scored = score_toxicity(docs, fit_toxicity(docs, labels, **options))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
