"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitloom.llm.rows import SPACE
from commitloom.session import settle

# About as many labelled documents take part in learning, all if there are fewer.
TRAIN_DOCS = 10_000
PENALTY = 1e-3
ROUNDS = 40
GOOD_FROM = 0.3
# Lines whose features are held at once.
LINES_AT_ONCE = 50_000

# What kinds of byte a line is counted by.
KINDS = {
    "lower": bytes(range(0x61, 0x7B)),
    "upper": bytes(range(0x41, 0x5B)),
    "digit": bytes(range(0x30, 0x3A)),
    "stop": b".,;:",
    "shout": b"!?",
    "quote": b"'\"()-/",
    "symbol": b"#$%&*+<=>@[\\]^_`{|}~",
    "lead": bytes(range(0xC0, 0x100)),
    "rest": bytes(range(0x80, 0xC0)),
    "space": SPACE,
}
_KIND = np.full(256, len(KINDS), np.int64)
for _at, _members in enumerate(KINDS.values()):
    _KIND[list(_members)] = _at
_N_KINDS = len(KINDS) + 1
_PLACE = {name: i for i, name in enumerate(KINDS)}
_SPACES = np.isin(np.arange(256), list(SPACE))

OWN = (
    "length",
    "words",
    "word_length",
    "upper",
    "digit",
    "stop",
    "shout",
    "quote",
    "symbol",
    "foreign",
    "one_sign_words",
    "same_words",
    "seen_line",
    "seen_windows",
    "ends_open",
)
FEATURES = ("one", "first", "last", *OWN, *(f"before_{n}" for n in OWN), *(f"after_{n}" for n in OWN))


def _seen_windows(words: list[bytes], line_of: np.ndarray, n_lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Per line: distinct words, and words in a three-word window that the text holds twice or more."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    distinct = np.bincount(np.unique(line_of * len(numbers) + ids) // max(1, len(numbers)), minlength=n_lines)
    repeated = np.zeros(len(ids), bool)
    if len(ids) >= 3:
        _, pairs = np.unique(ids[:-2] * len(numbers) + ids[1:-1], return_inverse=True)
        _, at, times = np.unique(pairs * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[at] >= 2)
        for shift in range(3):
            repeated[starts + shift] = True
    return distinct, np.bincount(line_of, repeated, n_lines)


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with a word, by ``FEATURES``, and its characters that are not space."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = data.split()
    if not words:
        return np.zeros((0, len(FEATURES)), np.float32), np.zeros(0, np.int64)
    points = np.frombuffer(data, np.uint8)
    line_of = np.cumsum(points == 0x0A)
    line_of -= points == 0x0A  # a line end belongs to its line
    n_lines = int(line_of[-1]) + 1
    kinds = np.bincount(line_of * _N_KINDS + _KIND[points], minlength=n_lines * _N_KINDS).reshape(n_lines, _N_KINDS)
    space = _SPACES[points]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]]))
    word_line = line_of[starts]
    n_words = np.bincount(word_line, minlength=n_lines)
    distinct, repeated = _seen_windows(words, word_line, n_lines)
    chars = kinds.sum(1) - kinds[:, _PLACE["space"]] - kinds[:, _PLACE["rest"]]
    one_sign = np.bincount(word_line, ends == starts, n_lines)
    seen: set[bytes] = set()
    again = np.zeros(n_lines)
    for i, line in enumerate(data.split(b"\n")[:n_lines]):
        key = line.strip(SPACE)
        again[i] = key in seen
        seen.add(key)
    kept = np.flatnonzero(n_words)
    finals = points[ends[np.cumsum(n_words)[kept] - 1]]
    kinds, chars, n_words = kinds[kept], chars[kept], n_words[kept]

    def share(part: np.ndarray, whole: np.ndarray = chars) -> np.ndarray:
        return np.sqrt(part / np.maximum(whole, 1))

    own = np.stack(
        [
            np.log1p(chars) / 8,
            np.log1p(n_words) / 6,
            np.minimum(chars / n_words, 40) / 10,
            *(share(kinds[:, _PLACE[k]]) for k in ("upper", "digit", "stop", "shout", "quote", "symbol", "lead")),
            share(one_sign[kept], n_words),
            share(n_words - distinct[kept], n_words),
            again[kept],
            share(repeated[kept], n_words),
            ~np.isin(finals, list(b".!?:;")),
        ],
        axis=1,
    )
    none = np.zeros((1, own.shape[1]))
    edge = np.zeros((len(own), 3))
    edge[:, 0], edge[0, 1], edge[-1, 2] = 1, 1, 1
    table = np.hstack([edge, own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none])])
    return table.astype(np.float32), chars


@dataclass(frozen=True)
class LineModel:
    """What a line's features add to good, what each change between lines adds, and the score of a text without lines."""

    weights: np.ndarray
    changes: np.ndarray
    empty: float

    @staticmethod
    def of(flat: np.ndarray, empty: float) -> LineModel:
        return LineModel(flat[:-4], flat[-4:].reshape(2, 2), empty)


def forward_backward(good: np.ndarray, lengths: np.ndarray, changes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log sums of the texts, each line's probability of good, and the expected changes per text.

    ``good`` holds the lines' scores for good (bad scores 0), the texts one
    after the other; ``changes[a, b]`` is what b after a scores.  All texts take
    a step together, so time is linear in the lines.
    """
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    counts = lengths[order]
    steps = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(steps), side="left")  # texts with a line at this step
    node = np.stack([np.zeros_like(good), good], axis=1)
    ahead, behind = np.empty_like(node), np.zeros_like(node)
    for step in range(steps):
        at = begins[: active[step]] + step
        if step == 0:
            ahead[at] = node[at]
        else:
            past = ahead[at - 1]
            ahead[at] = node[at] + np.logaddexp(past[:, :1] + changes[0], past[:, 1:] + changes[1])
    for step in range(steps - 2, -1, -1):
        at = begins[: active[step + 1]] + step
        later = node[at + 1] + behind[at + 1]
        behind[at] = np.logaddexp(changes[:, 0] + later[:, :1], changes[:, 1] + later[:, 1:])
    sums = np.zeros(len(lengths))
    full = lengths > 0
    lasts = np.cumsum(lengths)[full] - 1
    sums[full] = np.logaddexp(ahead[lasts, 0], ahead[lasts, 1])
    text = np.repeat(np.arange(len(lengths)), lengths)
    probability = np.exp(ahead[:, 1] + behind[:, 1] - sums[text])
    expected = np.zeros((len(lengths), 2, 2))
    if len(good) > 1:
        pair = np.flatnonzero(text[1:] == text[:-1])
        later = node[pair + 1] + behind[pair + 1]
        both = np.exp(ahead[pair][:, :, None] + changes[None] + later[:, None, :] - sums[text[pair]][:, None, None])
        np.add.at(expected, text[pair], both)
    return sums, np.clip(probability, 0.0, 1.0), expected


def _batches_of_lines(texts: list, lines: Callable[[object], int]) -> Iterator[list[int]]:
    group, total = [], 0
    for i, one in enumerate(texts):
        size = lines(one)
        if group and total + size > LINES_AT_ONCE:
            yield group
            group, total = [], 0
        group.append(i)
        total += size
    if group:
        yield group


def text_scores(texts: list[str | None], model: LineModel) -> list[tuple[float, list[float]]]:
    """Each text's mean probability of good, lines weighted by their characters, and the lines' own."""
    out: list[tuple[float, list[float]]] = [(model.empty, [])] * len(texts)
    for group in _batches_of_lines(texts, lambda t: t.count("\n") + 1 if t else 0):
        found = [line_features(texts[i]) for i in group]
        lengths = np.array([len(chars) for _, chars in found], np.int64)
        good = np.concatenate([table for table, _ in found]).astype(np.float64) @ model.weights
        _, marginals, _ = forward_backward(good, lengths, model.changes)
        for i, (_, chars), own in zip(group, found, np.split(marginals, np.cumsum(lengths)[:-1])):
            if len(own):
                out[i] = (float(np.clip((own * chars).sum() / chars.sum(), 0.0, 1.0)), own.tolist())
    return out


def _loss(batches: Iterator[pd.DataFrame], flat: np.ndarray) -> Iterator[pd.DataFrame]:
    """Log loss and gradient of the documents of one task; every line has its document's label."""
    total, gradient = 0.0, np.zeros_like(flat)
    model = LineModel.of(flat, 0.0)
    for batch in batches:
        tables = [np.frombuffer(b, np.float32).reshape(-1, len(FEATURES)) for b in batch["lines"]]
        labels = batch["label"].to_numpy(np.int64)
        for group in _batches_of_lines(tables, len):
            x = np.concatenate([tables[i] for i in group]).astype(np.float64)
            lengths, y = np.array([len(tables[i]) for i in group], np.int64), labels[group]
            good = x @ model.weights
            sums, marginals, expected = forward_backward(good, lengths, model.changes)
            each = np.repeat(y, lengths)
            same = np.maximum(lengths - 1, 0)
            counted = np.zeros((2, 2))
            np.add.at(counted, (y, y), same)
            total += sums.sum() - good[each == 1].sum() - (counted * model.changes).sum()
            gradient += np.concatenate([x.T @ (marginals - each), (expected.sum(0) - counted).ravel()])
    yield pd.DataFrame({"loss": [total], "gradient": [gradient.tobytes()]})


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, rounds: int) -> np.ndarray:
    """Limited-memory BFGS with step halving; ends early when steps gain nothing any more."""
    x, (value, slope) = start, loss(start)
    pairs: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=8)
    for _ in range(rounds):
        way, scales = slope.copy(), []
        for s, y in reversed(pairs):
            scales.append(s @ way / (s @ y))
            way -= scales[-1] * y
        if pairs:
            way *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1])
        else:
            way /= max(1.0, np.abs(slope).sum())
        for (s, y), scale in zip(pairs, reversed(scales)):
            way += s * (scale - y @ way / (s @ y))
        size, gain = 1.0, slope @ way
        while size > 1e-6:
            there = x - size * way
            new, new_slope = loss(there)
            if new <= value - 1e-4 * size * gain:
                break
            size /= 2
        else:
            return x
        if (there - x) @ (new_slope - slope) > 1e-12:
            pairs.append((there - x, new_slope - slope))
        done = value - new < 1e-5 * max(1e-3, abs(value))
        x, value, slope = there, new, new_slope
        if done:
            return x
    return x


def training_documents(
    documents: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train_docs: int = TRAIN_DOCS,
) -> DataFrame:
    """``label`` and the features of the ``lines`` of about ``train_docs`` labelled documents.

    Labels that are null or contradict each other teach nothing.  The ids
    with the smallest hashes are taken before texts are touched; of rows that
    repeat an id, the one with the smallest hash of its text teaches, so no id
    brings more than one document.
    """
    agreed = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("label"))
        .filter("label in (0, 1) and _id is not null")
        .groupBy("_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_most"))
        .filter("label = _most")
        .drop("_most")
    )
    agreed = settle(agreed, "agreed-labels")
    share = F.pmod(F.xxhash64("_id", F.lit("lines")), F.lit(2**30)) / F.lit(float(2**30))
    taken = agreed.filter(share * max(1, agreed.count()) < train_docs)

    def lines(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([line_features(t)[0].tobytes() for t in batch], dtype=object)

    lines.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    rows = documents.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    found = rows.join(taken, "_id").select("_id", "label", "_hash", F.pandas_udf(lines, "binary")("_text").alias("lines"))
    one = found.groupBy("_id", "label").agg(F.min_by("lines", "_hash").alias("lines"))
    return settle(one.select("label", "lines"), "line-features")


def train(examples: DataFrame, rounds: int = ROUNDS, penalty: float = PENALTY) -> LineModel:
    """Fit the field to ``examples(label, lines)`` by maximum likelihood with a squared penalty.

    Each step is a job: tasks return the loss and gradient of their documents,
    some hundred numbers, and the driver adds them up.  Without labels every
    line is as likely good as bad.  A text without a line scores the share of
    good among such texts, drawn to the share of good among all.
    """
    spark = examples.sparkSession
    empty = F.octet_length("lines") == 0
    row = examples.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("label"), F.lit(0)).alias("good"),
        F.count(F.when(empty, 1)).alias("n_empty"),
        F.coalesce(F.sum(F.when(empty, F.col("label"))), F.lit(0)).alias("good_empty"),
    ).first()
    overall = row["good"] / row["n"] if row["n"] else 0.5
    flat, of_empty = np.zeros(len(FEATURES) + 4), (row["good_empty"] + overall) / (row["n_empty"] + 1)
    if row["n"] == 0:
        return LineModel.of(flat, of_empty)

    def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
        shared = spark.sparkContext.broadcast(at)
        parts = examples.mapInPandas(lambda batches: _loss(batches, shared.value), "loss double, gradient binary").collect()
        shared.unpersist()
        parts = sorted(parts, key=lambda p: (p["loss"], bytes(p["gradient"])))
        total = sum(p["loss"] for p in parts) / row["n"] + penalty / 2 * at @ at
        return total, sum(np.frombuffer(p["gradient"]) for p in parts) / row["n"] + penalty * at

    return LineModel.of(minimise(loss, flat, rounds), of_empty)


def quality(spark: SparkSession, text: Column, model: LineModel) -> Column:
    """Struct of ``score`` and ``lines``, each line's probability of good, of every whole text."""
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(text_scores(batch.tolist(), shared.value), columns=["score", "lines"])

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(score, "score double, lines array<double>")(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document takes no part in learning: a fifth of them, by a checksum of the id."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def score_documents(
    documents: DataFrame, model: LineModel, doc_id: str = "doc_id", text: str = "text", good_from: float = GOOD_FROM
) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` and ``lines`` of every row; other columns play no part.

    Lines are cut at \\n; those without a word take no part and have no entry
    in ``lines``.  Null, empty and blank texts have no lines and score
    ``model.empty``.  Texts of any length are scored whole, in linear time.
    Equal texts score alike whatever their ids, repeated rows stay repeated,
    and an empty table gives an empty result.
    """
    found = documents.select(doc_id, quality(documents.sparkSession, F.col(text), model).alias("_q"))
    return found.select(
        doc_id, "_q.score", (F.col("_q.score") >= good_from).cast("int").alias("predicted"), F.col("_q.lines").alias("lines")
    )
