"""Language of text, and of its parts, from scripts, word scores and a Viterbi path."""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitloom.llm.rows import whole_rows
from commitloom.session import settle

UNDETERMINED = "und"
# The classifier is fitted on about this many labelled documents of each language.
TRAIN_DOCS = 10_000
# The table of gram weights never exceeds this many cells, however many languages there are.
TABLE_CELLS = 2**24
MAX_BUCKETS = 2**16
SMOOTHING = 0.2
# Overlapping grams repeat each other's evidence.
GRAM_WEIGHT = 0.4
# Nats that a change of language between two words costs.
SWITCH_PENALTY = 12.0
# The score of a language that does not write in a word's script: no path ever takes it.
EXCLUDED = -1e9
# Beyond this, a gain settles that a text is not of one language, or cannot be.
CLEAR_GAIN = 1e3
MIN_BUCKETS = 64
# A language writes in a script when this share of its letters is in it.
SCRIPT_SHARE = 0.01
UNIT_LETTERS = 24
CACHED_TOKENS = 400_000
WORDS_AT_ONCE = 20_000
STEP_CELLS = 4_000_000

# Blocks of the scripts, first and last code point.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF)),
    "ethiopic": ((0x1200, 0x137F),),
    "khmer": ((0x1780, 0x17FF),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "han": ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
OTHER_SCRIPT = "other"
SCRIPT_NAMES = (*SCRIPTS, OTHER_SCRIPT)
_BLOCKS = sorted((low, high, name) for name, blocks in SCRIPTS.items() for low, high in blocks)
_LOWS = [low for low, _, _ in _BLOCKS]
_SCRIPT_NUMBER = {name: number for number, name in enumerate(SCRIPT_NAMES)}
_MIX = np.uint64(0x9E3779B97F4A7C15)
# What a letter's place in a word multiplies it by.
_PLACES = np.multiply.accumulate(np.full(UNIT_LETTERS + 3, _MIX, np.uint64))
_TOKEN = re.compile(r"\S+")


def script_of(letter: str) -> str:
    point = ord(letter)
    at = bisect.bisect_right(_LOWS, point) - 1
    return _BLOCKS[at][2] if at >= 0 and point <= _BLOCKS[at][1] else OTHER_SCRIPT


def word_units(token: str) -> list[tuple[str, str]]:
    """The words of a token without spaces: (script, letters), cut where the script changes and when long."""
    lower = token.lower()
    letters = lower if lower.isalpha() else "".join(filter(str.isalpha, lower))
    if letters.isascii():
        runs = [("latin", letters)] if letters else []
    else:
        runs = []
        for letter in letters:
            script = script_of(letter)
            if runs and runs[-1][0] == script:
                runs[-1][1].append(letter)
            else:
                runs.append((script, [letter]))
        runs = [(script, "".join(part)) for script, part in runs]
    return [(s, part[i : i + UNIT_LETTERS]) for s, part in runs for i in range(0, len(part), UNIT_LETTERS)]


def gram_buckets(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed grams of two to four letters with the word's borders, and each whole word; and the word of each."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points.astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    of_word, begins = np.repeat(np.arange(len(words)), lengths), np.cumsum(lengths) - lengths
    hashes, owners = [], []
    for n in (2, 3, 4):
        whole = np.flatnonzero(of_word[: len(points) - n + 1] == of_word[n - 1 :])
        rolled = np.full(len(whole), n, np.uint64)
        for k in range(n):
            rolled = rolled * _MIX + points[whole + k]
        hashes.append(rolled)
        owners.append(of_word[whole])
    place = np.arange(len(points)) - np.repeat(begins, lengths)
    hashes.append(np.add.reduceat(points * _PLACES[place], begins) if len(words) else np.zeros(0, np.uint64))
    owners.append(np.arange(len(words)))
    mixed = np.concatenate(hashes)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), np.concatenate(owners)


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities of hashed grams, one column per language; the languages of each script."""

    langs: tuple[str, ...]
    weights: np.ndarray
    in_script: dict[str, np.ndarray]


def _counted(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    """Grams, and letters per script as negative buckets, of each language in the batches."""
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            tokens: Counter[str] = Counter()
            for text in texts:
                tokens.update(text.split())
            units = [(script, word, times) for token, times in tokens.items() for script, word in word_units(token)]
            counts = np.zeros(buckets + len(SCRIPT_NAMES), np.int64)
            for at in range(0, len(units), WORDS_AT_ONCE):
                scripts, words, times = zip(*units[at : at + WORDS_AT_ONCE])
                hashed, owners = gram_buckets(list(words), buckets)
                times = np.array(times, np.int64)
                counts[:buckets] += np.bincount(hashed, times[owners], buckets).astype(np.int64)
                letters = times * np.array([len(w) for w in words])
                np.add.at(counts, buckets + np.array([_SCRIPT_NUMBER[s] for s in scripts]), letters)
            found = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": lang, "bucket": found, "n": counts[found]})


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    spread_by: str = "doc_id",
    docs_per_lang: int = TRAIN_DOCS,
) -> LanguageModel:
    """Fit a model on rows with text and language.

    About ``docs_per_lang`` documents of each language are used, those with
    the smallest hashes of ``spread_by`` and text.  What comes to the driver is
    the table of gram counts, at most ``TABLE_CELLS`` numbers: beyond 256
    languages there are fewer buckets to hash grams into, so that all scores
    change with that number, and more languages than leave ``MIN_BUCKETS`` are
    refused.  Rows without text or language teach nothing; without any other
    the model knows no language.
    """
    rows = labelled.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(spread_by, text, F.lit("lang")).alias("_h")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = settle(
        labelled.filter(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("_docs")),
        "languages",
    )
    most = TABLE_CELLS // MIN_BUCKETS
    langs = tuple(row["lang"] for row in sizes.select("lang").orderBy("lang").limit(most + 1).collect())
    if len(langs) > most:
        raise ValueError(f"more than {most} languages")
    if not langs:
        return LanguageModel((), np.zeros((1, 0), np.float32), {})
    buckets = MAX_BUCKETS
    while buckets * len(langs) > TABLE_CELLS:
        buckets //= 2
    share = F.pmod(F.col("_h"), F.lit(2**30)) / F.lit(float(2**30))
    sample = rows.join(sizes, "lang").filter(share * F.col("_docs") < docs_per_lang).select("lang", "text")
    counted = (
        sample.mapInPandas(lambda batches: _counted(batches, buckets), "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    table = np.zeros((buckets + len(SCRIPT_NAMES), len(langs)), np.float64)
    place = {name: i for i, name in enumerate(langs)}
    columns = np.array([place[name] for name in counted["lang"].to_pylist()], np.int64)
    table[counted["bucket"].to_numpy(), columns] = counted["n"].to_numpy()
    grams, letters = table[:buckets], table[buckets:]
    weights = np.log((grams + SMOOTHING) / (grams.sum(0) + SMOOTHING * buckets)) * GRAM_WEIGHT
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(0), 1)
    return LanguageModel(langs, weights.astype(np.float32), dict(zip(SCRIPT_NAMES, uses)))


class _WordScores:
    """Tokens and the rows of their scores: -1 without letters, below -1 for a token of several words.

    Scripts narrow the candidates: a language that does not use a word's script
    has ``EXCLUDED`` there.  A word in a script that no language was seen in
    scores zero for all and is no evidence.
    """

    def __init__(self, model: LanguageModel) -> None:
        self.model, self.rows, self.several = model, {}, []
        self.table, self.used = np.zeros((1024, len(model.langs)), np.float32), 0
        self.tells = np.zeros(1024, bool)
        n = len(model.langs)
        self.allowed = np.stack([model.in_script.get(s, np.zeros(n, bool)) for s in SCRIPT_NAMES])

    def _add(self, scripts: list[str], words: list[str]) -> None:
        """Score new words, in the order given."""
        weights = self.model.weights
        hashed, owners = gram_buckets(words, len(weights))
        scores = np.stack([np.bincount(owners, column[hashed], len(words)) for column in weights.T], axis=1)
        allowed = self.allowed[[_SCRIPT_NUMBER[s] for s in scripts]]
        tells = allowed.any(1)
        scores = np.where(allowed, scores, np.where(tells, EXCLUDED, 0.0)[:, None])
        while self.used + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.tells = np.concatenate([self.tells, np.zeros_like(self.tells)])
        self.table[self.used : self.used + len(words)] = scores
        self.tells[self.used : self.used + len(words)] = tells
        self.used += len(words)

    def learn(self, tokens: set[str]) -> None:
        fresh, scripts, words = [t for t in tokens if t not in self.rows], [], []
        for token in fresh:
            units = word_units(token)
            at = self.used + len(words)
            if len(units) == 1:
                self.rows[token] = at
            elif not units:
                self.rows[token] = -1
            else:
                self.several.append(range(at, at + len(units)))
                self.rows[token] = -1 - len(self.several)
            scripts += [script for script, _ in units]
            words += [word for _, word in units]
            if len(words) >= WORDS_AT_ONCE:
                self._add(scripts, words)
                scripts, words = [], []
        if words:
            self._add(scripts, words)

    def words(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score row and token number of each word."""
        found = np.fromiter(map(self.rows.__getitem__, tokens), np.int64, len(tokens))
        at = np.arange(len(found))
        if len(found) and found.min() < -1:
            many = [self.several[-2 - f] if f < -1 else (f,) for f in found.tolist()]
            at = np.repeat(at, [len(m) for m in many])
            found = np.array([f for m in many for f in m], np.int64)
        kept = found >= 0
        return found[kept], at[kept]


def one_language(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """The best language of each text, and whether staying in it all along is the best path.

    It is when no stretch of words gains more from any other languages than
    one change costs: the largest sum over a stretch, of the best other
    language's score less its own, settles that without a path.
    """
    begins = np.cumsum(lengths) - lengths
    top = np.add.reduceat(scores, begins, axis=0, dtype=np.float64).argmax(1)
    if scores.shape[1] == 1:
        return top, np.ones(len(lengths), bool)
    text = np.repeat(np.arange(len(lengths)), lengths)
    at, own = np.arange(len(scores)), top[text]
    others = scores.astype(np.float64)
    others[at, own] = -np.inf
    # A word the language is excluded from opens a path by itself; a clear loss bounds what can be made up for.
    gain = np.clip(others.max(1) - scores[at, own], -CLEAR_GAIN, CLEAR_GAIN)
    after = np.cumsum(gain)
    after -= np.repeat(after[begins] - gain[begins], lengths)
    before = after - gain
    # Texts are set apart by a drop larger than all sums, so that a running minimum starts anew with each.
    drop = text * (np.ptp(before) + 1.0)
    lowest = np.minimum.accumulate(before - drop) + drop
    return top, np.maximum.reduceat(after - lowest, begins) <= penalty


def best_paths(scores: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Language of each word on the best path of its text.

    The texts stand one after the other in ``scores``, longest first.  All
    texts take a step together.
    """
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts with a word at this step
    before = np.empty(scores.shape, np.int32)
    own = np.arange(scores.shape[1], dtype=np.int32)[None, :]
    best = scores[begins[: active[0]]].astype(np.float64) if longest else None
    for step in range(1, longest):
        n = active[step]
        past = best[:n]
        top = past.argmax(1)
        switched = past[np.arange(n), top] - penalty
        stays = past >= switched[:, None]
        at = begins[:n] + step
        before[at] = np.where(stays, own, top[:, None])
        best[:n] = np.where(stays, past, switched[:, None]) + scores[at]
    labels = np.empty(len(scores), np.int32)
    for step in range(longest - 1, -1, -1):
        n = active[step]
        later = active[step + 1] if step + 1 < longest else 0
        at = begins[:n] + step
        labels[at[later:]] = best[later:n].argmax(1)
        labels[at[:later]] = before[at[:later] + 1, labels[at[:later] + 1]]
    return labels


def _spans(text: str, labels: np.ndarray, tokens: np.ndarray, langs: tuple[str, ...]) -> list[dict]:
    """Runs of one language as code point ranges; what stands between two runs belongs to the first."""
    changes = np.flatnonzero(labels[1:] != labels[:-1]) + 1
    first = len(text) - len(text.lstrip())
    if not len(changes):
        return [{"lang": langs[labels[0]], "start": first, "end": len(text.rstrip())}]
    begins = [match.start() for match in _TOKEN.finditer(text)]
    borders = [first, *(begins[tokens[c]] for c in changes), len(text.rstrip())]
    heads = [labels[0], *labels[changes]]
    return [{"lang": langs[lang], "start": a, "end": b} for lang, a, b in zip(heads, borders, borders[1:])]


def _label_texts(texts: list[str | None], cache: _WordScores, penalty: float) -> list[tuple]:
    langs = cache.model.langs
    out: list[tuple] = [(UNDETERMINED, 0.0, [])] * len(texts)
    if not langs:
        return out
    split = [text.split() if text else [] for text in texts]
    cache.learn({token for tokens in split for token in tokens})
    worded = [(i, *cache.words(tokens)) for i, tokens in enumerate(split)]
    worded = sorted((w for w in worded if len(w[1])), key=lambda w: -len(w[1]))
    limit = max(1, STEP_CELLS // len(langs))
    mixed = []
    for group in _groups(worded, limit):
        lengths = np.array([len(rows) for _, rows, _ in group], np.int64)
        rows = np.concatenate([rows for _, rows, _ in group])
        top, constant = one_language(cache.table[rows], lengths, penalty)
        evidence = np.add.reduceat(cache.tells[rows], np.cumsum(lengths) - lengths, dtype=np.int64) / lengths
        for one, lang, alone, share in zip(group, top.tolist(), constant.tolist(), evidence.tolist()):
            if alone:
                text = texts[one[0]]
                ends = len(text) - len(text.lstrip()), len(text.rstrip())
                out[one[0]] = (langs[lang], share, [{"lang": langs[lang], "start": ends[0], "end": ends[1]}])
            else:
                mixed.append(one)
    for group in _groups(mixed, limit):
        lengths = np.array([len(rows) for _, rows, _ in group], np.int64)
        labels = best_paths(cache.table[np.concatenate([rows for _, rows, _ in group])], lengths, penalty)
        for (i, rows, tokens), own in zip(group, np.split(labels, np.cumsum(lengths)[:-1])):
            counts = np.bincount(own[cache.tells[rows]], minlength=len(langs))
            lang = int(counts.argmax())
            out[i] = (langs[lang], float(counts[lang] / len(own)), _spans(texts[i], own, tokens, langs))
    return out


def _groups(worded: list[tuple], limit: int) -> Iterator[list[tuple]]:
    """Texts in turn, together at most ``limit`` words where more than one."""
    group, total = [], 0
    for one in worded:
        if group and total + len(one[1]) > limit:
            yield group
            group, total = [], 0
        group.append(one)
        total += len(one[1])
    if group:
        yield group


RESULT = "lang string, score double, spans array<struct<lang: string, start: int, end: int>>"
TEXTS_AT_ONCE = 1000


def language_of(
    spark: SparkSession, text: Column, model: LanguageModel, penalty: float = SWITCH_PENALTY
) -> Column:
    """Struct of ``lang``, ``score`` and ``spans`` of each whole text.

    ``lang`` holds the most words (the first by name among equals); ``score``
    is its share of all words, of which those in a script that no language of
    the model uses count for none, so that a text all in such a script has the
    first language with score 0.  ``spans`` are the runs of one language as
    ranges of code points, end exclusive.  Text that is null, empty or without
    a letter, and any text under a model of no language, is ``und`` with score
    0 and no spans.
    """
    shared = spark.sparkContext.broadcast(model)

    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = _WordScores(shared.value)
        for batch in batches:
            texts, found = batch.tolist(), []
            for i in range(0, len(texts), TEXTS_AT_ONCE):
                if len(cache.rows) > CACHED_TOKENS:
                    cache = _WordScores(shared.value)
                found += _label_texts(texts[i : i + TEXTS_AT_ONCE], cache, penalty)
            yield pd.DataFrame(found, columns=["lang", "score", "spans"])

    label.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(label, RESULT)(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document takes no part in learning: a third of them, by a checksum of the id."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def detect(documents: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``spans`` of every row; other columns play no part.

    Rows that repeat an id, or have none, are labelled each by its own text;
    an empty table gives an empty result.
    """
    found = documents.select(doc_id, language_of(documents.sparkSession, F.col(text), model).alias("_found"))
    return found.select(doc_id, F.col("_found.lang").alias("lang_pred"), "_found.score", "_found.spans")


def keep_determined(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Rows with a word that tells a language, as they are, also where they mix several.

    What goes has no letter (null and empty text too), or only words in scripts
    that no language of the model uses.  Under a model of no language nothing
    can be told, and all rows stay.
    """
    if not model.langs:
        return documents
    found = documents.select(
        whole_rows(documents), language_of(documents.sparkSession, F.col(text), model).alias("_found")
    )
    return found.filter(F.col("_found.score") > 0).select("_row.*")
