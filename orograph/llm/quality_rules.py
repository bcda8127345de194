"""Quality rules: decision lists learned from labelled text statistics.

``text_statistics`` measures every text; ``learn_rules`` covers the low-quality rows of a
labelled sample with ordered threshold conjunctions (grown on two thirds of it, pruned on the
rest); ``as_column`` turns the list into one ordered Spark conditional expression.

Repeated words and lines are told by 64-bit codes of their bytes: two given windows or lines of a text that differ share one
with a chance of about 2^-64, so a text of 10^6 words has a false repeat with a chance of about 1 in 37 million.

Defined results: a null or empty text has all statistics 0 and fails the base rule. Repeated rows
are measured one by one. An empty or one-sided label set gives a list without rules, which keeps
whatever passes the base rule. Columns beyond those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, arrow_map, flat, in_runs, per_text, run_codes, span_codes, spans, table

WINDOW = 5
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_stops", "n_pipes"]
MAX_SAMPLE = 12_000
"""Labelled rows, at most, that a list is learned from: those of the least id hash."""

_SYMBOL, _UPPER, _DIGIT, _STOP, _PIPE, _LEAD = (np.zeros(256, bool) for _ in range(6))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[0x41:0x5B] = True
_DIGIT[0x30:0x3A] = True
_STOP[list(b".!?")] = True
_PIPE[list(b"|")] = True
_LEAD[:] = (np.arange(256) & 0xC0) != 0x80


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, at = flat(batch.column(1))
    n = len(batch)
    starts, ends = spans(~SPACE[data], at)
    words = np.searchsorted(starts, at)
    word_owner = np.repeat(np.arange(n), np.diff(words))
    lead = np.concatenate([[0], np.cumsum(_LEAD[data])])
    chars = lead[ends] - lead[starts]

    windows = run_codes(span_codes(data, starts, ends), WINDOW)
    inside = word_owner[: len(windows)] == word_owner[WINDOW - 1 :] if len(windows) else np.zeros(0, bool)
    first = np.flatnonzero(inside)
    flags = np.zeros(len(windows), bool)
    flags[first] = _repeats(windows[first] ^ (word_owner[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    repeated = in_runs(flags, WINDOW, len(starts))

    line_at, line_end = spans(data != 10, at)
    with_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_at)
    line_at, line_end = line_at[with_word], line_end[with_word]
    owner = np.searchsorted(at, line_at, "right") - 1
    codes = span_codes(data, line_at, line_end)
    order = np.lexsort((codes, owner))
    again = (codes[order][1:] == codes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    dup = np.bincount(owner[order][1:][again], minlength=n)

    count = lambda kind: per_text(kind[data], at)
    columns = [np.diff(words), per_text(chars, words), count(_SYMBOL), dup, per_text(repeated, words), np.bincount(owner, minlength=n), count(_UPPER), count(_DIGIT), count(_STOP), count(_PIPE)]
    return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c.astype(np.int64)) for c in columns)], ["doc_id", *STATISTICS])


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATISTICS of every whole text; one row for each row of docs."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), _measure, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in STATISTICS), 1)


def _share(top: str, base: str) -> Column:
    return F.col(top).cast("double") / F.greatest(F.col(base), F.lit(1))


def features() -> dict[str, Column]:
    """What conditions may test, as columns over STATISTICS."""
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": _share("word_chars", "n_words"),
        "symbols": _share("n_symbols", "n_words"),
        "dup_lines": _share("n_dup_lines", "n_lines"),
        "repeats": _share("n_repeat_words", "n_words"),
        "line_words": _share("n_words", "n_lines"),
        "upper": _share("n_upper", "word_chars"),
        "digits": _share("n_digits", "word_chars"),
        "stops": _share("n_stops", "n_words"),
        "pipes": _share("n_pipes", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.feature)]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self, by_name: dict[str, Column]) -> Column:
        c = by_name[self.feature]
        return c >= F.lit(self.threshold) if self.above else c < F.lit(self.threshold)


Rule = list[Condition]


def _covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], longest: int) -> Rule:
    """Adds the condition of the greatest information gain until only bad rows are covered."""
    rule: Rule = []
    live = np.ones(len(x), bool)
    while len(rule) < longest and (bad & live).any() and (~bad & live).any():
        p0, n0 = (bad & live).sum(), (~bad & live).sum()
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for k, name in enumerate(names):
            order = np.argsort(x[live, k], kind="stable")
            v, y = x[live, k][order], bad[live][order]
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1
            if not len(cut):
                continue
            below = np.cumsum(y)[cut - 1]
            for above in (False, True):
                p = p0 - below if above else below
                n = (len(v) - cut if above else cut) - p
                gain = p * (np.log2(np.maximum(p, 1e-9) / (p + n)) - base)
                j = int(np.argmax(gain))
                if gain[j] > best[0]:
                    best = gain[j], Condition(name, above, float((v[cut[j]] + v[cut[j] - 1]) / 2))
        if best[1] is None:
            break
        rule.append(best[1])
        live &= best[1].holds(x, names)
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: list[str]) -> tuple[Rule, float]:
    """The beginning of the rule that does best on rows it wasn't grown on, and its precision there."""
    best: tuple[float, Rule, float] = (-1.0, [], 0.0)
    for k in range(1, len(rule) + 1):
        covered = _covers(rule[:k], x, names)
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        worth = (p - n) / (p + n + 1)
        if worth > best[0]:
            best = worth, rule[:k], (p + 1) / (p + n + 2)
    return best[1], best[2]


def learn_rules(x: np.ndarray, bad: np.ndarray, names: list[str], most: int = 12, longest: int = 4, precise: float = 0.75) -> list[Rule]:
    """Sequential covering: rules until the bad rows are covered or a pruned rule is not precise."""
    rules: list[Rule] = []
    while len(rules) < most and bad.sum() >= 3:
        third = np.arange(len(x)) % 3 == 2
        rule = _grow(x[~third], bad[~third], names, longest)
        rule, precision = _prune(rule, x[third], bad[third], names) if rule else ([], 0.0)
        covered = _covers(rule, x, names)
        if not rule or precision < precise or not (covered & bad).any():
            break
        rules.append(rule)
        x, bad = x[~covered], bad[~covered]
    return rules


def as_column(rules: list[Rule]) -> Column:
    """The ordered list as one expression: the first rule that holds rejects, else the row is kept."""
    by_name = features()
    out = F
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            test = test & c.column(by_name)
        out = out.when(test, F.lit(False))
    return F.lit(True) if out is F else out.otherwise(F.lit(True))


def learned(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> list[Rule]:
    """Rules from the labelled rows of docs; quality 0 is what they shall reject."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = F.broadcast(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample))  # max_sample rows of two numbers
    rows = text_statistics(docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi"))
    by_name = features()
    got = rows.join(sample, "doc_id").select(F.xxhash64("doc_id").alias("h"), "doc_id", "quality", *(c.alias(n) for n, c in by_name.items()))
    got = got.orderBy("h", "doc_id", *by_name).limit(2 * max_sample).toArrow()  # rows that repeat an id in a fixed order
    names = list(by_name)
    x = np.column_stack([got.column(n).to_numpy() for n in names]) if len(got) else np.zeros((0, len(names)))
    return learn_rules(x, got.column("quality").to_numpy() == 0 if len(got) else np.zeros(0, bool), names)


def quality(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """STATISTICS, base_failed and kept of every row of docs."""
    rules = learned(docs, labels, max_sample)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return text_statistics(docs).withColumn("base_failed", base).withColumn("kept", ~base & as_column(rules))


def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *STATISTICS[:5], "base_failed", "kept")
