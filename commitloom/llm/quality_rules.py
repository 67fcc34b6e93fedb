"""Quality by learned decision lists over counts of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitloom.llm.rows import SPACE
from commitloom.session import settle

# About as many labelled rows take part in learning; they come to the driver as counts, not as texts.
MAX_LABELLED = 20_000
# A rule stands if this share of the pruning rows it covers is bad, and it covers this many of them.
MIN_PRECISION = 0.9
MIN_COVER = 5

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(0x41, 0x5B))
_DIGITS = b"0123456789"
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_upper",
    "n_digits",
    "n_exclaim",
)
# What conditions may look at, in thousandths where it is a ratio.
FEATURES = {
    "n_words": "n_words",
    "mean_word": "1000 * word_chars div greatest(n_words, 1)",
    "symbols": "1000 * n_symbols div greatest(word_chars, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
    "distinct": "1000 * n_distinct_words div greatest(n_words, 1)",
    "upper": "1000 * n_upper div greatest(word_chars, 1)",
    "digits": "1000 * n_digits div greatest(word_chars, 1)",
    "exclaim": "1000 * n_exclaim div greatest(word_chars, 1)",
}


def _deleted(text: bytes, what: bytes) -> int:
    return len(text) - len(text.translate(None, what))


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Distinct words, and words inside a three-word window that occurs twice or more."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(ids) < 3:
        return len(numbers), 0
    # Two steps, so that the pair numbers stay small whatever the text's length.
    _, pairs = np.unique(ids[:-2] * len(numbers) + ids[1:-1], return_inverse=True)
    _, at, times = np.unique(pairs * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[at] >= 2)
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[starts + shift] = True
    return len(numbers), int(covered.sum())


def count_text(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    distinct, repeats = repeated_words(words)
    lines = [line for line in data.split(b"\n") if line.strip(SPACE)]
    return (
        len(words),
        len(text) - _deleted(data, SPACE),
        _deleted(data, _SYMBOLS),
        len(lines) - len(set(lines)),
        repeats,
        len(lines),
        distinct,
        _deleted(data, _UPPER),
        _deleted(data, _DIGITS),
        data.count(b"!"),
    )


def text_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every whole text; null and empty texts count nothing."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([count_text(t) for t in batch], columns=list(COUNTS), dtype="int64")

    count.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    counter = F.pandas_udf(count, ", ".join(f"{name} long" for name in COUNTS))
    return documents.select(doc_id, counter(F.col(text)).alias("_counts")).select(doc_id, "_counts.*")


def features() -> list[Column]:
    return [F.expr(rule).cast("long").alias(name) for name, rule in FEATURES.items()]


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: int

    def holds(self, table: np.ndarray) -> np.ndarray:
        values = table[:, list(FEATURES).index(self.feature)]
        return values >= self.threshold if self.at_least else values < self.threshold

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def covers(self, table: np.ndarray) -> np.ndarray:
        held = np.ones(len(table), bool)
        for condition in self.conditions:
            held &= condition.holds(table)
        return held

    def column(self) -> Column:
        held = F.lit(True)
        for condition in self.conditions:
            held = held & condition.column()
        return held

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _best_condition(table: np.ndarray, bad: np.ndarray) -> tuple[float, Condition | None]:
    """The condition that gains most: bad rows kept times the growth in the log share of bad rows."""
    n_bad, n = int(bad.sum()), len(bad)
    best: tuple[float, Condition | None] = (0.0, None)
    for i, name in enumerate(FEATURES):
        order = np.argsort(table[:, i], kind="stable")
        values, below = table[order, i], np.concatenate([[0], np.cumsum(bad[order])])
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        for at_least in (True, False):
            p = (n_bad - below[cuts]) if at_least else below[cuts]
            t = (n - cuts) if at_least else cuts
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / t) - np.log2(n_bad / n)), 0.0)
            if len(gain) and gain.max() > best[0] + 1e-9:
                cut = cuts[int(gain.argmax())]
                threshold = int(values[cut - 1] + values[cut] + 1) // 2  # half way into the gap
                best = (float(gain.max()), Condition(name, at_least, threshold))
    return best


def learn_rules(table: np.ndarray, bad: np.ndarray, prune: np.ndarray) -> list[Rule]:
    """Sequential covering: grow a rule on some rows, prune it on the others, take out what it covers.

    ``prune`` marks the rows kept back for pruning.  A rule grows until it
    covers bad rows only or no condition gains.  Learning ends when no bad row
    is left or the next rule does not stand on the rows kept back; each rule
    takes out ``MIN_COVER`` of these at least, so there are no more rules than
    they allow.
    """
    rules: list[Rule] = []
    while bad[~prune].any() and bad[prune].any():
        grown: list[Condition] = []
        rows, wrong = table[~prune], bad[~prune]
        while not wrong.all():
            gain, condition = _best_condition(rows, wrong)
            if condition is None:
                break
            grown.append(condition)
            held = condition.holds(rows)
            rows, wrong = rows[held], wrong[held]
        best: tuple[float, Rule] | None = None
        for size in range(1, len(grown) + 1):
            rule = Rule(tuple(grown[:size]))
            held = rule.covers(table[prune])
            p, n = int(bad[prune][held].sum()), int((~bad[prune])[held].sum())
            if p >= MIN_COVER and p / (p + n) >= MIN_PRECISION:
                worth = (p - n) / max(1, bad[prune].sum()) + 1e-6 * p / (p + n)
                if best is None or worth > best[0]:
                    best = (worth, rule)
        if best is None:
            break
        rules.append(best[1])
        left = ~best[1].covers(table)
        table, bad, prune = table[left], bad[left], prune[left]
    return rules


def fit_rules(counts: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> list[Rule]:
    """Rules for bad documents (label 0), from about ``MAX_LABELLED`` labelled rows, all if there are fewer.

    Documents whose labels are null or contradict each other teach nothing.
    The rows taken are those with the smallest hashes of ``doc_id``; of rows
    that repeat an id, the one with the smallest features, so that no id brings
    more than one row to the driver.
    """
    agreed = (
        labels.filter(F.col(label).isNotNull())
        .groupBy(doc_id)
        .agg(F.min(label).alias("_label"), F.max(label).alias("_most"))
        .filter(F.col("_label") == F.col("_most"))
        .drop("_most")
    )
    spread = F.xxhash64(F.col(doc_id), F.lit("quality"))
    # The share of the labels that makes up the sample is known before anything is sent to the driver.
    share = F.pmod("_spread", F.lit(2**30)) / F.lit(float(2**30))
    one = F.min(F.struct(*features())).alias("_one")
    rows = (
        counts.join(agreed, doc_id)
        .withColumn("_spread", spread)
        .filter(share * agreed.count() < MAX_LABELLED)
        .groupBy(doc_id, "_spread", "_label")
        .agg(one)
        .select("_spread", "_label", "_one.*")
        .toPandas()
        .sort_values(["_spread", *FEATURES], ignore_index=True)
    )
    table = rows[list(FEATURES)].to_numpy(np.int64)
    return learn_rules(table, (rows["_label"] == 0).to_numpy(), (rows["_spread"] % 3 == 0).to_numpy())


def first_rule(rules: list[Rule]) -> Column:
    """Number from 1 of the first rule that covers the row, else null: one ordered conditional expression."""
    found = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        found = F.when(rule.column(), number).otherwise(found)
    return found


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, list[Rule]]:
    """Every row's counts, ``base_failed``, ``kept``, ``rule`` and ``rule_text``; and the rules.

    Texts are counted in one pass; the counts, a narrow table, are written
    out and serve both for learning and for the verdicts.  Without usable
    labels there are no rules, and only the base rule drops documents.  Null,
    empty and blank texts count nothing and fail the base rule.  Repeated rows
    and rows with a null id are judged each by its own text, and an empty table
    gives an empty result.
    """
    counts = settle(text_counts(documents, doc_id, text), "text-counts")
    rules = fit_rules(counts, labels, doc_id)
    texts = F.array(*[F.lit(str(rule)) for rule in rules]) if rules else F.array().cast("array<string>")
    judged = counts.withColumns({"base_failed": base_failed(), "rule": first_rule(rules)})
    return judged.withColumns(
        {
            "kept": ~F.col("base_failed") & F.col("rule").isNull(),
            "rule_text": F.get(texts, F.col("rule") - 1),
        }
    ), rules
