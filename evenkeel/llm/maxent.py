"""LM scoring: a hashed maximum-entropy model with n-gram and skip features and a class-factored softmax.

1. Texts are cut into words once. A chunk of texts is written as the hashes of its different words, whose low five bits
   tell the class of the word's ending, and the place of each word among them. Words of all training texts are counted
   from that, chunk by chunk in the tasks, the rest by Spark.
2. The ``HEAD_WORDS`` most frequent words and the end of a text are put into classes of 64 with like endings. All other
   words, seen or not, belong to the class of their ending. So p(word | history) = p(class | history) times
   p(word | class, history) for a head word, and times (c + 1) / (sum of counts + words + 1) within its class for any
   other, where one place per class is kept for what was never seen.
3. Both softmaxes add rows of hashed weights to fixed logarithms of the counts: for classes the rows of the word before,
   of the two words before and, as a skip, of the second word before; for head words those of the word before and of
   the skip, each with the class. Without weights the model is the smoothed unigram model.
4. Training takes every training document once, in ``ROUNDS`` parts. In each, tasks start from the weights so far and
   take gradient steps over their documents; Spark averages each row over the tasks by its number of tokens.
5. Chunks are turned into texts of packed class and head numbers. Words that are neither in the head nor in the broadcast
   table of counts go through a join with all counts, so none is left out and nothing unbounded is broadcast.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import Numbers, by_bytes, pin, runs, scrambled, text_bytes, tidy, words_in

CLASS_WORDS = 64  # head words in a class
HEAD_CLASSES = 64
HEAD_WORDS = CLASS_WORDS * HEAD_CLASSES  # with the end of a text
ENDINGS = 32  # classes of all other words
KNOWN_WORDS = 1 << 19  # words whose counts are broadcast: 16 bytes each
CLASS_ROWS, WORD_ROWS = 1 << 15, 1 << 14  # hashed rows of weights
ROUNDS = 2  # parts of the training documents between which weights are averaged
STEP_TOKENS = 4096  # tokens in a gradient step
RATE = 2.0
TASK_TOKENS, TASKS = 4 << 20, 8192  # least tokens of a training task, and most such tasks
CHUNK_BYTES = 4 << 20  # text whose words are numbered together

_OUT = HEAD_CLASSES + ENDINGS
_START = HEAD_WORDS + ENDINGS  # stands before a text's first word
_NEVER = np.float32(-1e9)
_BACK = 2  # words of history

# A-Z to lower case, the six word separators to blanks, all other bytes as they are.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))

Batches = Iterable[pa.RecordBatch]


def _numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) & ~(ENDINGS - 1) | zlib.crc32(word[-2:]) % ENDINGS


END = word_hash(b"")  # no word is empty


def _numbered(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the different words, all words as places among them, and words per text."""
    numbers = Numbers()
    found, lengths = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
    for place, text in enumerate(texts):
        for some in words_in(text, _FOLD):
            found.append(np.fromiter(map(numbers.__getitem__, some), np.int64, len(some)))
            lengths[place] += len(some)
    return np.fromiter(map(word_hash, numbers), np.uint64, len(numbers)), np.concatenate(found), lengths


_CHUNK = "doc_ids array<long>, held_out array<boolean>, lengths array<long>, hashes binary, words binary"


@tidy
def _chunks(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Texts in chunks: the hashes of the different words, and each word's place among them."""
    for part in by_bytes(batches, "body", CHUNK_BYTES):
        hashes, words, lengths = _numbered(part.column("body").to_pylist())
        one = lambda array: pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array)
        columns = [
            one(part.column("doc_id").combine_chunks()),
            one(part.column("held_out").combine_chunks()),
            one(pa.array(lengths)),
            pa.array([hashes.tobytes()], pa.binary()),
            pa.array([words.astype(np.uint32).tobytes()], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _CHUNK.split(", ")])


def _opened(batches: Batches) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each chunk: doc_ids, held_out, lengths, hashes, words."""
    for batch in batches:
        for at in range(batch.num_rows):
            ids, out, lengths = (batch.column(name)[at].values for name in ("doc_ids", "held_out", "lengths"))
            hashes = np.frombuffer(batch.column("hashes")[at].as_buffer(), np.uint64)
            words = np.frombuffer(batch.column("words")[at].as_buffer(), np.uint32).astype(np.int64)
            yield ids, out.to_numpy(zero_copy_only=False).astype(bool), lengths.to_numpy(), hashes, words


def _counts(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Words of the training texts of each chunk and how often they come."""
    for _, out, lengths, hashes, words in _opened(batches):
        times = np.bincount(words[np.repeat(~out, lengths)], minlength=len(hashes))
        seen = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays([pa.array(hashes[seen].view(np.int64)), pa.array(times[seen])], names=["h", "n"])


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the training tokens. ``counts`` has every word; the arrays have the broadcast ones, sorted by hash."""

    counts: DataFrame
    known: np.ndarray
    known_n: np.ndarray
    least: int  # words with a lower count are not in ``known``
    head: np.ndarray  # hashes of the head words, in the order of their numbers
    head_n: np.ndarray
    texts: int
    tokens: int
    words: int
    ending_mass: np.ndarray  # per class of endings: counts and words outside the head, and one place

    @property
    def base_mass(self) -> int:
        return self.tokens + self.words + 1

    def class_logs(self) -> np.ndarray:
        """Logarithms of the classes' unigram probabilities."""
        mass = np.zeros(HEAD_CLASSES)
        np.add.at(mass, np.arange(len(self.head)) // CLASS_WORDS, self.head_n + 1.0)
        mass = np.concatenate([mass, self.ending_mass])
        with np.errstate(divide="ignore"):
            return np.maximum(np.log(mass / mass.sum()), _NEVER).astype(np.float32)

    def word_logs(self) -> np.ndarray:
        """Per class the logarithms of its words' unigram probabilities within it."""
        mass = np.zeros(HEAD_WORDS)
        mass[: len(self.head)] = self.head_n + 1.0
        mass = mass.reshape(HEAD_CLASSES, CLASS_WORDS)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = np.log(mass / mass.sum(1, keepdims=True))
        return np.where(mass > 0, found, _NEVER).astype(np.float32)


def cut_words(docs: DataFrame) -> DataFrame:
    """Chunks of the words of all texts (doc_id, held_out, body), written to the shared folder."""
    return pin(docs.select("doc_id", "held_out", "body").mapInArrow(_chunks, _CHUNK), "maxent-words")


def count_words(chunks: DataFrame, known_words: int = KNOWN_WORDS) -> Vocabulary:
    """Count the words of the chunks' training texts. The driver gets how many words have which count (by powers of two), then the words
    at or above the lowest bound that leaves at most ``known_words`` of them."""
    counts = pin(chunks.mapInArrow(_counts, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "maxent-counts")
    learnt = F.size(F.filter("held_out", lambda x: ~x)).cast("long")
    total = chunks.agg(F.coalesce(F.sum(learnt), F.lit(0)).alias("n")).first().n
    by_power = counts.groupBy((F.length(F.bin("n")) - 1).alias("p")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, held = 1 << 62, 0
    for row in sorted(by_power, key=lambda r: -r.p):
        held += row.words
        if held > known_words:
            break
        least = 1 << row.p
    if least == 1 << 62 and by_power:  # even the most frequent words are too many: none is broadcast
        least = 1 << (max(r.p for r in by_power) + 1)
    # One ending's class is dealt by hash; both are sums over all words.
    ending = F.pmod("h", F.lit(ENDINGS))
    sums = counts.groupBy(ending.alias("k")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    frequent = counts.where(F.col("n") >= least).toArrow()
    known, known_n = frequent.column("h").to_numpy().view(np.uint64), frequent.column("n").to_numpy()
    order = np.argsort(known)
    known, known_n = known[order], known_n[order]

    best = np.lexsort((known, -known_n))[: HEAD_WORDS - 1]
    head, head_n = np.append(known[best], np.uint64(END)), np.append(known_n[best], total)
    order = np.lexsort((head, -head_n, head % np.uint64(ENDINGS)))
    head, head_n = head[order], head_n[order]
    mass = np.ones(ENDINGS)
    for row in sums:
        mass[row.k] += row.n + row.words
    own = np.flatnonzero(head != np.uint64(END))
    np.subtract.at(mass, (head[own] % np.uint64(ENDINGS)).astype(np.int64), head_n[own] + 1.0)
    tokens, words = sum(r.n for r in sums) + total, sum(r.words for r in sums) + (total > 0)
    return Vocabulary(counts, known, known_n, least, head, head_n, total, tokens, words, mass)


def _at(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted values, and which of them are there."""
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return place, sorted_values[place] == wanted


_ENCODED = (
    "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, tail double, ids binary, "
    "rare array<long>, times array<long>"
)


@tidy
def _encode(batches: Batches, shared) -> Iterator[pa.RecordBatch]:
    """Per text its numbers (head word, else HEAD_WORDS + ending), what is known of its counts, and its rare words."""
    v = shared.value
    key = TaskContext.get().partitionId() << 33
    by_hash = np.argsort(v["head"])
    for doc_ids, out, lengths, hashes, words in _opened(batches):
        hashes = np.append(hashes, np.uint64(END))
        # The end of each text follows its last word.
        words = np.insert(words, np.cumsum(lengths), len(hashes) - 1)
        lengths = lengths + 1
        ends = np.cumsum(lengths)
        place, in_head = _at(v["head"][by_hash], hashes)
        ending = (hashes % np.uint64(ENDINGS)).astype(np.int64)
        number = np.where(in_head, by_hash[place], HEAD_WORDS + ending)
        place, known = _at(v["known"], hashes)
        n = np.where(known, v["known_n"][place] if len(v["known"]) else 0, 0)
        n[-1], known[-1] = v["texts"], True
        base = np.where(known, np.log10((n + 1) / v["base_mass"]), 0.0)
        tail = np.where(known & ~in_head, np.log10((n + 1) / v["ending_mass"][ending]), 0.0)
        ids = number.astype(np.int16)[words]
        text_of = np.repeat(np.arange(len(lengths)), lengths)
        rare = np.flatnonzero(~known[words])
        pair = np.sort(text_of[rare] * len(hashes) + words[rare])
        first, times = runs(pair)
        rare_text, rare_word = np.divmod(pair[first], len(hashes))
        rare_of = np.searchsorted(rare_text, np.arange(len(lengths) + 1)).astype(np.int32)
        per_text = lambda values: np.add.reduceat(values[words], ends - lengths)
        rows = {
            "key": key + np.arange(len(lengths)),
            "doc_id": doc_ids,
            "held_out": out,
            "n_tokens": lengths,
            "n_known": per_text((known & (n > 0)).astype(np.int64)),
            "base_score": per_text(base),
            "tail": per_text(tail),
            "ids": pa.array([ids[a:b].tobytes() for a, b in zip((ends - lengths).tolist(), ends.tolist())], pa.binary()),
            "rare": pa.ListArray.from_arrays(rare_of, pa.array(hashes[rare_word].view(np.int64))),
            "times": pa.ListArray.from_arrays(rare_of, pa.array(times.astype(np.int64))),
        }
        key += len(lengths)
        yield pa.RecordBatch.from_pydict({k: x if isinstance(x, pa.Array) else pa.array(x) for k, x in rows.items()})


class Weights:
    """Rows of weights, the sum of squares of all gradients that moved each row, and the tokens these came from."""

    def __init__(self, start: Weights | None = None) -> None:
        self.classes = np.zeros((CLASS_ROWS, _OUT), np.float32) if start is None else start.classes.copy()
        self.words = np.zeros((WORD_ROWS, CLASS_WORDS), np.float32) if start is None else start.words.copy()
        self.class_force = np.zeros(CLASS_ROWS) if start is None else start.class_force.copy()
        self.word_force = np.zeros(WORD_ROWS) if start is None else start.word_force.copy()
        self.class_seen, self.word_seen = np.zeros(CLASS_ROWS), np.zeros(WORD_ROWS)

    def packed(self) -> tuple[np.ndarray, ...]:
        """For broadcasting: half the bytes."""
        return self.classes.astype(np.float16), self.words.astype(np.float16), self.class_force, self.word_force

    @staticmethod
    def unpacked(parts: tuple[np.ndarray, ...] | None) -> Weights:
        w = Weights()
        if parts is not None:
            w.classes[:], w.words[:], w.class_force[:], w.word_force[:] = parts
        return w

    def matrices(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return [(self.classes, self.class_force, self.class_seen), (self.words, self.word_force, self.word_seen)]


def _rows(kind: np.ndarray, rows: int, *values: np.ndarray) -> np.ndarray:
    mixed = kind.astype(np.uint64)
    for value in values:
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + value.astype(np.uint64) + np.uint64(1)
    return (scrambled(mixed) >> np.uint64(20)).astype(np.int64) & (rows - 1)


def _histories(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each token the two before it in its text, the nearer one first."""
    at = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    found = np.full((len(ids), _BACK), _START, np.int64)
    for back in range(1, _BACK + 1):
        inside = np.flatnonzero(at >= back)
        found[inside, back - 1] = ids[inside - back]
    return found


def _class_rows(before: np.ndarray) -> np.ndarray:
    one, two = before.T
    kind = np.zeros(len(one), np.int64)
    parts = [(kind, one), (kind + 1, one, two), (kind + 2, two)]
    return np.stack([_rows(part[0], CLASS_ROWS, *part[1:]) for part in parts], 1)


def _word_rows(before: np.ndarray, classes: np.ndarray) -> np.ndarray:
    kind = np.zeros(len(classes), np.int64)
    return np.stack([_rows(kind + 8 + i, WORD_ROWS, before[:, i], classes) for i in range(_BACK)], 1)


def _summed(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = weights.take(rows[:, 0], axis=0)
    for i in range(1, rows.shape[1]):
        total += weights.take(rows[:, i], axis=0)
    return total


def _log_of(scores: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax at one place per row; ``scores`` is used up."""
    scores -= scores.max(1, keepdims=True)
    chosen = scores[np.arange(len(wanted)), wanted].astype(np.float64)
    return chosen - np.log(np.exp(scores, out=scores).sum(1))


def log_probabilities(ids: np.ndarray, before: np.ndarray, w: Weights, class_logs: np.ndarray, word_logs: np.ndarray) -> np.ndarray:
    """Natural logarithms of p(class) and, for head words, p(word | class) of each token after its history."""
    classes = np.where(ids < HEAD_WORDS, ids // CLASS_WORDS, ids - HEAD_WORDS + HEAD_CLASSES)
    found = _log_of(class_logs + _summed(w.classes, _class_rows(before)), classes)
    head = np.flatnonzero(ids < HEAD_WORDS)
    own = classes[head]
    scores = _summed(w.words, _word_rows(before[head], own))
    scores += word_logs.take(own, axis=0)
    found[head] += _log_of(scores, ids[head] % CLASS_WORDS)
    return found


def _running_sum(values: np.ndarray) -> np.ndarray:
    """Sums of the rows up to each row: within blocks, then over the blocks, so that every addition is a wide one."""
    n, width = values.shape
    block = max(1, math.isqrt(n))
    blocks = -(-n // block)
    padded = np.zeros((blocks, block, width), values.dtype)
    padded.reshape(-1, width)[:n] = values
    for at in range(1, block):
        padded[:, at] += padded[:, at - 1]
    before = np.cumsum(padded[:-1, -1], axis=0)
    padded[1:] += before[:, None]
    return padded.reshape(-1, width)[:n]


def _move(
    weights: np.ndarray, force: np.ndarray, seen: np.ndarray, rows: np.ndarray, gradient: np.ndarray, rate: float
) -> None:
    """Step every row by the sum of its tokens' gradients, divided by the root of all its squares so far."""
    flat = rows.ravel().astype(np.uint16)  # as many rows as there can be; sorted by digits
    order = np.argsort(flat, kind="stable")
    first, size = runs(flat[order])
    own = flat[order[first]]
    # Sums of runs as differences of one running sum, which is much faster than adding up run by run.
    running = _running_sum(gradient.take(order // rows.shape[1], axis=0))
    total = running.take(first + size - 1, axis=0)
    total[1:] -= total[:-1].copy()
    seen[own] += size
    force[own] += np.einsum("ij,ij->i", total, total)
    total *= (rate / np.sqrt(force[own] + 1e-6)).astype(np.float32)[:, None]
    total += weights.take(own, axis=0)
    weights[own] = total


def gradient_step(
    ids: np.ndarray, before: np.ndarray, w: Weights, class_logs: np.ndarray, word_logs: np.ndarray, rate: float = RATE
) -> None:
    classes = np.where(ids < HEAD_WORDS, ids // CLASS_WORDS, ids - HEAD_WORDS + HEAD_CLASSES)
    head = np.flatnonzero(ids < HEAD_WORDS)
    for matrix, rows, logs, wanted in zip(
        w.matrices(),
        (_class_rows(before), _word_rows(before[head], classes[head])),
        (class_logs, word_logs[classes[head]]),
        (classes, ids[head] % CLASS_WORDS),
    ):
        if not len(wanted):
            continue
        scores = logs + _summed(matrix[0], rows)
        scores -= scores.max(1, keepdims=True)
        gradient = np.exp(scores, out=scores)
        gradient /= -gradient.sum(1, keepdims=True)
        gradient[np.arange(len(wanted)), wanted] += 1
        _move(*matrix, rows, gradient, rate / rows.shape[1])


def _token_chunks(batches: Batches, tokens: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Whole texts of about ``tokens`` tokens; a longer one comes alone."""
    for part in by_bytes(batches, "ids", 2 * tokens):
        texts = part.column("ids").to_pylist()
        yield part, np.frombuffer(b"".join(texts), np.int16).astype(np.int64), np.array([len(x) // 2 for x in texts])


_MOVED = "matrix int, place int, seen double, force double, moved binary"
_MOVED_KINDS = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary()]
_MOVED_NAMES = [part.split()[0] for part in _MOVED.split(", ")]


@tidy
def _train(batches: Batches, shared) -> Iterator[pa.RecordBatch]:
    """Take gradient steps from the shared weights; return how far each row moved, and by how many tokens."""
    state = shared.value
    start = Weights.unpacked(state["weights"])
    w = Weights(start)
    for _, ids, lengths in _token_chunks(batches, 64 * STEP_TOKENS):
        before = _histories(ids, lengths)
        for at in range(0, len(ids), STEP_TOKENS):
            part = slice(at, at + STEP_TOKENS)
            gradient_step(ids[part], before[part], w, state["class_logs"], state["word_logs"])
    for matrix, ((new, force, seen), (old, force_before, _)) in enumerate(zip(w.matrices(), start.matrices())):
        own = np.flatnonzero(seen)
        for some in np.array_split(own, max(1, len(own) // 4096)):
            moved = (new[some] - old[some]).astype(np.float16)
            values = [np.full(len(some), matrix), some, seen[some], force[some] - force_before[some]]
            columns = [pa.array(x, k) for x, k in zip(values, _MOVED_KINDS)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x.tobytes() for x in moved], pa.binary())], names=_MOVED_NAMES)


@tidy
def _average(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Mean movement of each row, weighted by tokens. Rows come sorted by matrix, place and task."""
    held: tuple | None = None  # matrix, place, tokens, squares and movement summed so far

    def shown(matrix, place, seen, force, total) -> pa.RecordBatch:
        means = [x.tobytes() for x in (total / seen[:, None]).astype(np.float32)]
        values = [matrix, place, seen, force / seen, means]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(values, _MOVED_KINDS)], names=_MOVED_NAMES)

    for batch in batches:
        matrix, place, seen, force = (_numpy(batch, name) for name in _MOVED_NAMES[:4])
        moved = batch.column("moved").to_pylist()
        for own in np.split(np.arange(len(matrix)), np.flatnonzero(np.diff(matrix)) + 1) if len(matrix) else []:
            values = np.frombuffer(b"".join(moved[own[0] : own[-1] + 1]), np.float16).reshape(len(own), -1)
            values = values.astype(np.float64) * seen[own, None]
            first, _ = runs(place[own])
            sums = [matrix[own][first], place[own][first]]
            sums += [np.add.reduceat(x, first, axis=0) for x in (seen[own], force[own] * seen[own], values)]
            if held is not None:
                if (held[0][0], held[1][0]) == (sums[0][0], sums[1][0]):
                    for x, before in zip(sums[2:], held[2:]):
                        x[0] += before[0]
                else:
                    yield shown(*held)
            yield shown(*[x[:-1] for x in sums])
            held = tuple(x[-1:] for x in sums)
    if held is not None:
        yield shown(*held)


def train(encoded: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Weights:
    """Weights after every training text was taken once. The driver holds one copy of the weights, whose size is fixed."""
    spark = encoded.sparkSession
    w = Weights()
    tasks = max(1, min(math.ceil(vocabulary.tokens / rounds / TASK_TOKENS), TASKS))
    for number in range(rounds):
        state = {"weights": w.packed() if number else None}
        state |= {"class_logs": vocabulary.class_logs(), "word_logs": vocabulary.word_logs()}
        shared = spark.sparkContext.broadcast(state)
        own = encoded.where(~F.col("held_out") & (F.pmod(F.xxhash64("key"), F.lit(rounds)) == number)).select("ids")
        moved = own.coalesce(tasks).mapInArrow(lambda batches: _train(batches, shared), _MOVED)
        moved = moved.withColumn("task", F.spark_partition_id())
        moved = moved.repartition("matrix", "place").sortWithinPartitions("matrix", "place", "task").drop("task")
        found = pin(moved.mapInArrow(_average, _MOVED), "maxent-weights").toArrow()
        shared.destroy()
        w = Weights.unpacked(state["weights"])  # as the tasks had them
        matrix, place, squares = (found.column(c).to_numpy() for c in ("matrix", "place", "force"))
        steps = found.column("moved").to_pylist()
        for m, (weights, force, _) in enumerate(w.matrices()):
            own = np.flatnonzero(matrix == m)
            if len(own):
                weights[place[own]] += np.frombuffer(b"".join([steps[i] for i in own]), np.float32).reshape(len(own), -1)
                force[place[own]] += squares[own]
    return w


_SCORED = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


@tidy
def _score(batches: Batches, shared) -> Iterator[pa.RecordBatch]:
    state = shared.value
    w = Weights.unpacked(state["weights"])
    for part, ids, lengths in _token_chunks(batches, 64 * STEP_TOKENS):
        before = _histories(ids, lengths)
        logs = np.zeros(len(ids))
        for at in range(0, len(ids), STEP_TOKENS):
            some = slice(at, at + STEP_TOKENS)
            logs[some] = log_probabilities(ids[some], before[some], w, state["class_logs"], state["word_logs"])
        ends = np.cumsum(lengths)
        total = np.add.reduceat(logs, ends - lengths) / math.log(10)  # every text has at least its end
        names = [name.split()[0] for name in _SCORED.split(", ")]
        columns = [part.column(name).combine_chunks() for name in names[:-1]]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(total + part.column("tail").to_numpy())], names=names)


def held_out(doc_id: Column) -> Column:
    """Whether a document is not learnt from; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score_texts(docs: DataFrame, known_words: int = KNOWN_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text; other columns are ignored, whatever their names).

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``, repeated
    ones too. A null or empty text is its end alone. A null doc_id is learnt from. Without training texts nothing is
    known and the model is uniform over the classes of endings and the end. Words are told apart by 59 bits of hash
    within their class of endings.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_bytes().alias("body")
    )
    chunks = cut_words(rows)
    v = count_words(chunks, known_words)
    known = {name: getattr(v, name) for name in ("known", "known_n", "head", "texts", "base_mass", "ending_mass")}
    shared = spark.sparkContext.broadcast(known)
    encoded = pin(chunks.mapInArrow(lambda batches: _encode(batches, shared), _ENCODED), "maxent-encoded")
    shared.destroy()
    w = train(encoded, v, rounds)
    model = spark.sparkContext.broadcast({"weights": w.packed(), "class_logs": v.class_logs(), "word_logs": v.word_logs()})
    scored = encoded.drop("rare", "times").mapInArrow(lambda batches: _score(batches, model), _SCORED)

    rare = encoded.where(F.size("rare") > 0).select("key", F.explode(F.arrays_zip("rare", "times")).alias("r"))
    rare = rare.select("key", F.col("r.rare").alias("h"), F.col("r.times").alias("times"))
    counted = rare.join(v.counts.where(F.col("n") < v.least), "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    mass = F.element_at(F.array(*[F.lit(float(x)) for x in v.ending_mass]), F.pmod("h", F.lit(ENDINGS)).cast("int") + 1)
    sums = counted.groupBy("key").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * F.log10((F.col("n") + 1) / float(v.base_mass))).alias("_base"),
        F.sum(F.col("times") * F.log10((F.col("n") + 1) / mass)).alias("_tail"),
    )
    zero = F.lit(0.0)
    return scored.join(sums, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("_tail", zero)).alias("score"),
    )
