"""Quality rules: a decision list learned from labelled statistics, applied as ordered Spark conditions.

Statistics of every text are counted in one pass. Sequential covering learns rules that reject: a rule grows by adding
the threshold condition with the largest information gain on two thirds of the labelled rows, and is pruned on the
last third by dropping final conditions while that raises its worth there; the rows it covers leave and the next rule
is grown, until a rule is not precise enough. Learning takes a bounded sample of labelled rows (``most_rows``), narrow
numbers only; the statistics themselves and the verdicts cover every row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import at_most, by_bytes, hash_words, hashed_place, pin, rolling_hash, runs, spare, text_bytes, tidy

MOST_ROWS = 50_000
CHUNK_BYTES = 2 << 20  # text looked at together
WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
CUTS = 64  # thresholds tried per feature
MOST_RULES = 24
MOST_CONDITIONS = 4
LEAST_PRECISION = 0.9
LEAST_COVER = 5

_BASE = 0xA0761D6478BD642F
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_digits",
          "n_marks", "n_lines", "longest_word"]
# What rules look at: shares that do not depend on a text's length, and the length.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "distinct_words": "n_distinct / greatest(n_words, 1)",
    "capitals": "n_upper / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "longest_word": "longest_word",
}


def repeated_window_words(hashes: np.ndarray, width: int) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text."""
    windows = rolling_hash(hashes, width, _BASE)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    _, size = runs(windows[order])
    if size.max() < 2:
        return 0
    twice = order[np.repeat(size, size) > 1]
    change = np.zeros(len(hashes) + 1, np.int64)
    change[twice] += 1
    change[twice + width] -= 1
    return int((np.cumsum(change)[:-1] > 0).sum())


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS``."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    body = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(body.decode("utf-8", "replace")),
        len(body) - len(body.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_window_words(hash_words(words), WINDOW),
        len(set(words)),
        len(body) - len(body.translate(None, _UPPER)),
        len(body) - len(body.translate(None, _DIGITS)),
        body.count(b"!") + body.count(b"?"),
        len(lines),
        max(map(len, words), default=0),
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the ``COUNTS`` of every row of ``docs`` (doc_id, text), and ``crc`` to tell texts of one doc_id apart."""

    @tidy
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "body", CHUNK_BYTES):
            rows = [text_counts(text) for text in batch["body"].to_pylist()]
            columns = [pa.array([row[i] for row in rows], pa.int64()) for i in range(len(COUNTS))]
            own = [batch[name].combine_chunks() for name in ("doc_id", "crc")]
            yield pa.record_batch([*own, *columns], ["doc_id", "crc", *COUNTS])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_crc().alias("crc"), text_bytes().alias("body"))
    return rows.mapInArrow(count, "doc_id long, crc long, " + ", ".join(f"{name} long" for name in COUNTS))


def text_crc() -> Column:
    return F.crc32(F.coalesce(text_bytes(), F.lit(b"")))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        column = values[self.feature]
        return column > self.threshold if self.above else column <= self.threshold

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    """Rejects a text for which all conditions hold."""

    conditions: tuple[Condition, ...]

    def covers(self, values: dict[str, np.ndarray]) -> np.ndarray:
        covered = np.ones(len(next(iter(values.values()))), bool)
        for condition in self.conditions:
            covered &= condition.holds(values)
        return covered

    def sql(self) -> str:
        return " and ".join(condition.sql() for condition in self.conditions)


def _gain(p: np.ndarray, n: np.ndarray, before: float) -> np.ndarray:
    """FOIL's gain: rejected rows kept times the bits by which they stand out more."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = p * (np.log2(p / (p + n)) - before)
    return np.where(p > 0, gain, -np.inf)


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule | None:
    conditions: list[Condition] = []
    live = np.ones(len(bad), bool)
    while len(conditions) < MOST_CONDITIONS and live.any() and bad[live].any() and not bad[live].all():
        before = np.log2(bad[live].mean())
        best: tuple[float, Condition] | None = None
        for feature, column in values.items():
            own, own_bad = column[live], bad[live]
            cuts = np.unique(np.quantile(own[own_bad], np.linspace(0, 1, CUTS)))
            cuts = np.unique(np.concatenate([cuts, np.quantile(own, np.linspace(0, 1, CUTS))]))
            place = np.searchsorted(cuts, own, side="left")  # own <= cuts[k] from k = place on
            p_low = np.cumsum(np.bincount(place[own_bad], minlength=len(cuts) + 1))[: len(cuts)]
            n_low = np.cumsum(np.bincount(place[~own_bad], minlength=len(cuts) + 1))[: len(cuts)]
            p, n = own_bad.sum(), (~own_bad).sum()
            for above, found in ((False, _gain(p_low, n_low, before)), (True, _gain(p - p_low, n - n_low, before))):
                at = int(np.argmax(found))
                if found[at] > (best[0] if best else 1e-9):
                    best = (float(found[at]), Condition(feature, above, float(cuts[at])))
        if best is None:
            break
        conditions.append(best[1])
        live &= best[1].holds(values)
    return Rule(tuple(conditions)) if conditions else None


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    covered = rule.covers(values)
    p, n = int(bad[covered].sum()), int((~bad[covered]).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules that reject, from feature columns and the rows' verdicts (true: reject). No rows: no rules."""
    left, rules = np.arange(len(bad)), []
    while len(rules) < MOST_RULES and bad[left].any():
        third = np.arange(len(left)) % 3 == 2
        part = {True: left[~third], False: left[third]}
        grow, check = ({k: v[part[g]] for k, v in values.items()} for g in (True, False))
        rule = _grow(grow, bad[part[True]])
        if rule is None:
            break
        shorter = [Rule(rule.conditions[:n]) for n in range(1, len(rule.conditions) + 1)]
        rule = max(reversed(shorter), key=lambda r: _worth(r, check, bad[part[False]]))
        covered = rule.covers({k: v[left] for k, v in values.items()})
        if covered.sum() < LEAST_COVER or bad[left][covered].mean() < LEAST_PRECISION:
            break
        rules.append(rule)
        left = left[~covered]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered Spark condition: the number of the first rule that rejects, null for none."""
    if not rules:
        return F.lit(None).cast("int")
    cases = "".join(f" when {rule.sql()} then {number}" for number, rule in enumerate(rules))
    return F.expr(f"case{cases} end")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)


def judge(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> tuple[DataFrame, list[Rule]]:
    """Statistics and verdict per row of ``docs`` (doc_id, text), and the rules, learned from ``labels`` (doc_id, quality).

    Columns: doc_id, crc, the ``COUNTS``, base_failed, rule (the first that rejects, null: none), kept. Rows are learned
    from at most ``most_rows``, chosen by a hash of doc_id and text, those that pass the base checks only. A doc_id that is
    labelled twice counts as its worse label; null labels and null ids teach nothing. Without labels there are no rules
    and the base checks alone decide. Null and empty texts have no words and fail them. Repeated rows give repeated rows.
    """
    counted = pin(text_statistics(docs), "statistics").withColumn("base_failed", base_failed())
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("_labelled"))
    marks = marks.agg(F.min("quality").alias("_quality"))
    taught = counted.where(~F.col("base_failed")).join(marks, F.col("doc_id") == F.col("_labelled"))
    order = F.xxhash64("doc_id")
    # Labelled rows are counted first; only a little more than the sample leaves the tasks.
    taught = at_most(taught, hashed_place("doc_id", "crc"), taught.count(), most_rows)
    sample = (
        taught.select(order.alias("_order"), "doc_id", "_quality", *[F.expr(f"double({sql})").alias(f) for f, sql in FEATURES.items()])
        .orderBy("_order", "doc_id", *FEATURES)
        .limit(most_rows)
        .toPandas()
    )
    values = {feature: sample[feature].to_numpy(float) for feature in FEATURES}
    rules = learn_rules(values, (sample["_quality"] == 0).to_numpy(bool))
    judged = counted.withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def kept_documents(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, as they are."""
    judged, _ = judge(docs, labels, most_rows)
    known, crc = spare(docs.columns, "_id", "_crc")
    good = judged.where("kept").select(F.col("doc_id").alias(known), F.col("crc").alias(crc)).distinct()
    return docs.join(good, F.col("doc_id").eqNullSafe(F.col(known)) & (text_crc() == F.col(crc)), "left_semi")
