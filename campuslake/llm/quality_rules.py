"""Quality rules: fixed base rules, then a decision list learned from labelled documents.

Statistics are counted over the whole text. The list is learned by sequential covering: a rule
is a conjunction of thresholds that is grown greedily on one part of the labelled documents,
pruned from its end on the other part, and kept if it is precise there; the documents it covers
are set aside and the next rule is learned from the rest. The ordered rules become one Spark
conditional expression, so applying them is a projection.

Learning reads at most ``SAMPLE`` labelled documents, those with the smallest hash of their id.

Defined results: a null or empty text has no words and fails the base rules; rates over nothing
are zero; null labels are ignored, several labels of a document count as the worst of them, of
repeated documents one is learned from; without labels of both kinds there are no rules and
every document that passes the base rules is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import annotate
from .textarrays import Texts, lookup, mix, ranges_hash, repeats, running, windows_hash

#: Labelled documents that the list is learned from, at most.
SAMPLE = 20_000
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SYMBOLS = lookup(b"#*$%&|<>")
CAPITALS = lookup(bytes(range(ord("A"), ord("Z") + 1)))
NEWLINE = 0x0A

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_echoes")
STATISTICS = StructType([StructField(name, LongType()) for name in COUNTS])


def count_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``STATISTICS`` for each text of a slice."""
    texts = Texts(column)
    data, bounds = texts.data, texts.bounds
    characters = (data & 0xC0) != 0x80
    out = {
        "n_words": texts.n_words,
        "word_chars": texts.per_text(running(texts.in_word & characters)),
        "n_symbols": texts.per_text(running(SYMBOLS[data])),
        "n_capitals": texts.per_text(running(CAPITALS[data])),
    }

    breaks = np.flatnonzero(data == NEWLINE)
    starts = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]))
    owner = np.searchsorted(texts.offsets, starts, "right") - 1
    ends = np.sort(np.concatenate([texts.offsets[1:], breaks]))
    # A line begins at each text's start and after each line feed inside a text; the line after
    # a final line feed is empty and belongs to no one.
    words_before = np.searchsorted(texts.starts, np.stack([starts, ends]))
    filled = words_before[1] > words_before[0]
    starts, ends, owner = starts[filled], ends[filled], owner[filled]
    keys = mix(ranges_hash(data, starts, ends) + owner.astype(np.uint64))
    _, later = repeats(keys)
    out["n_lines"] = np.bincount(owner, minlength=len(texts))
    out["n_dup_lines"] = np.bincount(owner[later], minlength=len(texts))

    hashes = texts.word_hashes()
    windows = windows_hash(hashes, REPEAT_WINDOW)
    document = np.repeat(np.arange(len(texts)), texts.n_words)
    first = np.arange(len(windows))
    inside = document[: len(windows)] == document[REPEAT_WINDOW - 1 :][: len(windows)] if len(windows) else first
    first = first[inside.astype(bool)]
    often, _ = repeats(mix(windows[first] + document[first].astype(np.uint64)))
    marks = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(marks, first[often], 1)
    np.add.at(marks, first[often] + REPEAT_WINDOW, -1)
    covered = running(np.cumsum(marks[:-1]) > 0)
    out["n_repeat_words"] = covered[bounds[1:]] - covered[bounds[:-1]]

    echoes = np.zeros(len(hashes), bool)
    echoes[1:] = (hashes[1:] == hashes[:-1]) & (document[1:] == document[:-1])
    echoed = running(echoes)
    out["n_echoes"] = echoed[bounds[1:]] - echoed[bounds[:-1]]
    return out


def statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Documents as (row, found) with the counts of their texts."""
    return annotate(docs, lambda: count_statistics, STATISTICS, text, keep)


def rates(c: str = "found") -> dict[str, Column]:
    """What rules put thresholds on, from the counts in column ``c``."""

    def rate(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"{c}.{part}"), F.col(f"{c}.{whole}")), F.lit(0.0))

    return {
        "n_words": F.col(f"{c}.n_words").cast("double"),
        "word_length": rate("word_chars", "n_words"),
        "symbol_rate": rate("n_symbols", "word_chars"),
        "capital_rate": rate("n_capitals", "word_chars"),
        "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"),
        "echo_rate": rate("n_echoes", "n_words"),
    }


def base_failed(c: str = "found") -> Column:
    """Too few words, or too many of them in windows that repeat."""
    return (F.col(f"{c}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{c}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{c}.n_words")
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values > self.threshold if self.above else values <= self.threshold

    def column(self, c: str = "found") -> Column:
        value = rates(c)[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Sequence[Condition], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    held = np.ones(n, bool)
    for condition in rule:
        held &= condition.holds(x[condition.feature])
    return held


def _cuts(values: np.ndarray, most: int = 64) -> np.ndarray:
    """Midpoints between neighbouring distinct values, at quantiles where there are many."""
    distinct = np.unique(values)
    middle = (distinct[1:] + distinct[:-1]) / 2
    if len(middle) > most:
        middle = middle[np.linspace(0, len(middle) - 1, most).astype(int)]
    return middle


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> list[Condition]:
    """Add the threshold with the largest information gain until no good document is covered."""
    rule: list[Condition] = []
    held = np.ones(len(bad), bool)
    while len(rule) < most:
        p, n = int(bad[held].sum()), int((~bad[held]).sum())
        if not p or not n:
            break
        best, gain = None, 1e-9
        for feature, values in x.items():
            for cut in _cuts(values[held]):
                for above in (True, False):
                    condition = Condition(feature, above, float(cut))
                    now = held & condition.holds(values)
                    p1, n1 = int(bad[now].sum()), int((~bad[now]).sum())
                    if p1:
                        more = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                        if more > gain:
                            best, gain = condition, more
        if best is None:
            break
        rule.append(best)
        held &= best.holds(x[best.feature])
    return rule


def _prune(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    """The shortest beginning of the rule that is worth most on documents it was not grown on."""

    def worth(k: int) -> float:
        held = _covers(rule[:k], x, len(bad))
        p, n = int(bad[held].sum()), int((~bad[held]).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))] if rule else rule


def learn_list(
    x: dict[str, np.ndarray],
    bad: np.ndarray,
    max_rules: int = 12,
    max_conditions: int = 4,
    min_precision: float = 0.9,
    min_covered: int = 3,
) -> list[Rule]:
    """Ordered rules for bad documents; every third document is held back for pruning."""
    order = np.arange(len(bad))
    held_back = order % 3 == 2
    left = np.ones(len(bad), bool)
    rules: list[Rule] = []
    while len(rules) < max_rules and bad[left].any():
        grow, prune = left & ~held_back, left & held_back
        rule = _grow({f: v[grow] for f, v in x.items()}, bad[grow], max_conditions)
        rule = _prune(rule, {f: v[prune] for f, v in x.items()}, bad[prune])
        held = _covers(rule, x, len(bad)) & left
        if not rule or bad[held].sum() < min_covered or bad[held].mean() < min_precision:
            break
        tested = held & held_back
        if tested.any() and bad[tested].mean() < min_precision:
            break
        rules.append(tuple(rule))
        left &= ~held
    return rules


def learn_rules(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE
) -> list[Rule]:
    """The decision list for the labelled documents among ``docs``."""
    named = (
        labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("label_key"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("label_key"), "label_key")
        .limit(sample)
    )
    # At most ``sample`` rows of two numbers, so the broadcast is bounded.
    labelled = docs.select(F.col(f"`{key}`").alias("label_key"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(named), "label_key"
    )
    counted = statistics(labelled, keep=["label_key", "quality"]).where(~base_failed())
    values = rates()
    rows = (
        counted.select("row.*", *[v.alias(f) for f, v in values.items() if f != "n_words"], values["n_words"].alias("n_words"))
        .groupBy("label_key", "quality")
        .agg(F.min(F.struct(*values)).alias("x"))
        .select("label_key", "quality", "x.*")
        .toPandas()
    )
    rows = rows.assign(h=mix(rows["label_key"].to_numpy().astype(np.int64).astype(np.uint64))).sort_values("h")
    return learn_list({f: rows[f].to_numpy(float) for f in values}, rows["quality"].to_numpy() == 0)


def verdict(rules: Sequence[Rule], c: str = "found") -> Column:
    """True for documents to keep: the first rule that holds rejects, none keeps."""
    keep = F.lit(True)
    for rule in reversed(rules):
        held = F.lit(True)
        for condition in rule:
            held = held & condition.column(c)
        keep = F.when(held, F.lit(False)).otherwise(keep)
    return keep


def judge(
    docs: DataFrame, labels: DataFrame, text: str = "text", keep: Sequence[str] | None = None, key: str = "doc_id"
) -> DataFrame:
    """Documents as (row, found, base_failed, kept)."""
    rules = learn_rules(docs, labels, text, key)
    return (
        statistics(docs, text, keep)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & verdict(rules))
    )
