"""Phrase collocations counted over a dictionary of content-triggered chunks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitloom.llm.marks import MARK_BITS, likely, mark_table, marked
from commitloom.operators.ranking import top_n_per_group
from commitloom.session import settle

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
# A chunk ends where a window of as many words as chunks overlap by hashes to 0 modulo this.
TRIGGER = 64
# Different phrases a task holds before it passes their counts on.
HELD_PHRASES = 1_000_000
# Phrases that are summed together, at most, when they are counted by hash alone.
RANGE_PHRASES = 2**22
# Words of more bytes are hashed one by one.
LONG_WORD = 1024
BYTES_AT_ONCE = 2_000_000
UNKNOWN = "und"

# What ends a piece, and what stands between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_GAP, _END = 0x20, 0x2E
_FOLD = bytes(
    _END if b in PIECE_ENDS else _GAP if b in b" \t" else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def folded(text: str | None) -> bytes:
    """A to Z in lower case, a space between words and ``.``, which no word holds, between pieces."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD) if text else b""


class Words:
    """The words of folded texts: where they begin and end, which piece holds them, and their hashes."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        points = np.frombuffer(data, np.uint8)
        ends = points == _END
        word = np.zeros(len(points) + 2, bool)
        np.logical_not(ends | (points == _GAP), out=word[1:-1])
        edges = np.flatnonzero(word[1:] != word[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(ends, dtype=np.int64)[self.starts]

    def __len__(self) -> int:
        return len(self.starts)

    def owners(self, texts: list[bytes]) -> np.ndarray:
        """Of texts joined by one byte, the number of the one that holds each word."""
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        firsts = np.append(np.searchsorted(self.starts, begins), len(self))
        return np.repeat(np.arange(len(begins)), np.diff(firsts))

    def hashes(self, lane: int) -> np.ndarray:
        """64 bits of each word's bytes, eight bytes a step; the same word has the same hash anywhere."""
        multiplier, buffer = _MULTIPLIERS[lane], self.data + bytes(8)
        eight = np.ndarray((len(self.data) + 1,), "<u8", buffer, strides=(1,))
        at, left = self.starts, self.ends - self.starts
        found = _mixed((left.astype(np.uint64) ^ eight[at] & _FIRST_BYTES[np.minimum(left, 8)]) * multiplier)
        long = np.flatnonzero(left > LONG_WORD)
        for i in long.tolist():
            found[i] = xxhash.xxh3_64_intdigest(self.data[at[i] : at[i] + left[i]], lane)
        active = np.flatnonzero((left > 8) & (left <= LONG_WORD))
        step = 8
        while len(active):
            rest = left[active] - step
            block = eight[at[active] + step] & _FIRST_BYTES[np.minimum(rest, 8)]
            found[active] = _mixed((found[active] ^ block) * multiplier)
            active, step = active[rest > 8], step + 8
        return found


def phrase_hashes(words: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """A hash of the ``size`` words from each place on that has as many after it."""
    n = max(0, len(words) - size + 1)
    rolled = np.full(n, size, np.uint64)
    for k in range(size):
        rolled = rolled * _MULTIPLIERS[lane] + words[k : n + k]
    return _mixed(rolled)


def chunks(texts: list[bytes], trigger: int = TRIGGER, overlap: int = MAX_WORDS - 1) -> list[tuple[int, bytes, int]]:
    """Folded texts as chunks: the text's number, the chunk, and of how many words phrases are its own.

    A window of ``overlap`` words whose hash is 0 modulo ``trigger`` ends a
    chunk and begins the next, so that equal passages are cut alike wherever
    they stand.  A phrase belongs to the chunk in which it begins before the
    overlap; it then ends in that chunk too.
    """
    words = Words(b".".join(texts))
    text = words.owners(texts)
    windows = phrase_hashes(words.hashes(0), overlap)
    inside = np.zeros(len(words) + 1, bool)
    # A cut is not a text's first word, and its window ends in the text.
    inside[1 : len(windows)] = (text[1 : len(windows)] == text[: max(0, len(windows) - 1)]) & (
        text[1 : len(windows)] == text[overlap : overlap + max(0, len(windows) - 1)]
    )
    cut = inside[:-1]
    cut[: len(windows)] &= windows % np.uint64(trigger) == 0
    if len(words):
        cut |= np.concatenate([[True], text[1:] != text[:-1]])
    first = np.flatnonzero(cut)
    after = np.append(first[1:], len(words))
    goes_on = np.append(text[first[1:]] == text[first[:-1]], False) if len(first) else first.astype(bool)
    last = np.where(goes_on, after + overlap, after) - 1
    spans = zip(text[first].tolist(), words.starts[first].tolist(), words.ends[last].tolist(), (after - first).tolist())
    return [(number, words.data[a:b], own) for number, a, b, own in spans]


def chunk_dictionary(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    trigger: int = TRIGGER,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """The different chunks: ``lang``, ``chunk``, ``own`` (words that begin its own phrases), ``n`` and ``id``.

    ``n`` is how often the parse holds the chunk, ``id`` 48 bits of its hash.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs = batch["lang"].tolist()
            found = Counter(
                (langs[i], chunk, own) for i, chunk, own in chunks([folded(t) for t in batch["text"]], trigger, max(1, max_words - 1))
            )
            rows = [(name, chunk, own, n) for (name, chunk, own), n in found.items()]
            yield pd.DataFrame(rows, columns=["lang", "chunk", "own", "n"])

    rows = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    parsed = rows.filter("text is not null").mapInPandas(parse, "lang string, chunk binary, own long, n long")
    distinct = parsed.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))
    name = F.shiftrightunsigned(F.xxhash64("lang", "chunk", "own"), 16)
    return settle(distinct.withColumn("id", name), "chunks")


class Batch:
    """The chunks of a batch as one run of words, a piece's end between two, with each word's weight as a phrase's beginning."""

    def __init__(self, rows: pd.DataFrame) -> None:
        given = rows["chunk"].tolist()
        self.words = Words(b".".join(given))
        self.chunk = self.words.owners(given)
        sizes = np.bincount(self.chunk, minlength=len(given))
        place = np.arange(len(self.words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = place < rows["own"].to_numpy(np.int64)[self.chunk]
        self.weight = np.where(own, rows["n"].to_numpy(np.int64)[self.chunk], 0)
        self.id, self.langs = rows["id"].to_numpy(np.int64), rows["lang"].tolist()
        self.lanes = []
        for lane in (0, 1):
            salts = {one: xxhash.xxh3_64_intdigest(one.encode("utf-8", "surrogatepass"), lane) for one in set(self.langs)}
            salted = np.array([salts[one] for one in self.langs], np.uint64)
            self.lanes.append(self.words.hashes(lane) ^ salted[self.chunk])

    def hashes(self, size: int) -> np.ndarray:
        """Hash of the phrase of ``size`` words from each place on, in its language."""
        return phrase_hashes(self.lanes[0], size, 0)

    def checks(self, size: int, at: np.ndarray) -> np.ndarray:
        """32 more bits to tell phrases apart by."""
        return (phrase_hashes(self.lanes[1], size, 1)[at] >> np.uint64(32)).astype(np.int64)

    def begins(self, size: int) -> np.ndarray:
        """Whether a phrase of ``size`` words, within a piece, that is its chunk's own begins there."""
        piece, n = self.words.piece, max(0, len(self.words) - size + 1)
        return (piece[size - 1 : size - 1 + n] == piece[:n]) & (self.weight[:n] > 0)

    def phrase(self, place: int, size: int) -> str:
        span = self.words.data[self.words.starts[place] : self.words.ends[place + size - 1]]
        return b" ".join(w for w in span.split(b" ") if w).decode("utf-8", "surrogatepass")


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[Batch]:
    for frame in frames:
        if len(frame):
            sizes = np.cumsum([len(c) for c in frame["chunk"]])
            for _, rows in frame.groupby((sizes - 1) // BYTES_AT_ONCE):
                yield Batch(rows)


def _counted(phrases: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Hash, check, count and least chunk of each different phrase of those given.

    Phrases of one hash and different checks stay apart, though not always in one piece each.
    """
    h, check, n, chunk = (np.concatenate(x) for x in zip(*phrases))
    if not len(h):
        return h, check, n, chunk
    order = np.argsort(h, kind="stable")
    h, check = h[order], check[order]
    heads = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])]))
    return h[heads], check[heads], np.add.reduceat(n[order], heads), np.minimum.reduceat(chunk[order], heads)


def _places(batch: Batch, sizes: tuple[int, ...], below: np.ndarray | None, below_size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each size: the size, where the batch's own phrases begin that can be frequent, and their hashes."""
    usual = marked(below, batch.hashes(below_size)) if below is not None else None
    for size in sizes:
        valid = batch.begins(size)
        if usual is not None:
            for shift in range(size - below_size + 1):
                valid &= usual[shift : shift + len(valid)]
        at = np.flatnonzero(valid)
        yield size, at, batch.hashes(size)[at]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and the sum of each."""
    order = np.argsort(keys)
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    return keys[heads], np.add.reduceat(n[order], heads) if len(keys) else n


def often(
    dictionary: DataFrame,
    sizes: tuple[int, ...],
    below: np.ndarray | None,
    below_size: int,
    min_count: int,
    bits: int = MARK_BITS,
) -> np.ndarray:
    """Marks of the phrases that occur ``min_count`` times by 32 bits or more of their hash: all frequent ones and few others.

    A task passes on, for each range of hashes, the low 32 bits of those it
    has seen and how often, five bytes a phrase.  Ranges are as many as keep
    the phrases of one to about ``RANGE_PHRASES``.
    """
    shared = dictionary.sparkSession.sparkContext.broadcast(below)
    places = (dictionary.agg(F.sum("own")).first()[0] or 0) * len(sizes)
    ranges = np.uint64(1 << max(6, (places // RANGE_PHRASES).bit_length()))
    # No phrase needs to be counted beyond what is asked for.
    kind = np.uint8 if min_count < 256 else np.int64

    def packed(keys: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        range_of = (keys >> np.uint64(32)).astype(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], range_of[1:] != range_of[:-1], [True]])) if len(keys) else np.zeros(1, np.int64)
        low, n = keys.astype("<u4"), np.minimum(n, min_count).astype(kind)
        rows = [(int(range_of[i]), low[i:j].tobytes(), n[i:j].tobytes()) for i, j in zip(edges[:-1], edges[1:])]
        return pd.DataFrame(rows, columns=["range", "low", "n"])

    def seen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, new = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), 0
        fresh: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in _batches(frames):
            for _, at, hashes in _places(batch, sizes, shared.value, below_size):
                fresh.append((hashes & ((ranges << np.uint64(32)) - np.uint64(1)), batch.weight[at]))
                new += len(at)
            if new > HELD_PHRASES:
                held, fresh, new = _summed(*map(np.concatenate, zip(held, *fresh))), [], 0
                if len(held[0]) > HELD_PHRASES:
                    yield packed(*held)
                    held = (held[0][:0], held[1][:0])
        yield packed(*_summed(*map(np.concatenate, zip(held, *fresh))))

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        low = np.concatenate([np.frombuffer(x, "<u4") for x in rows["low"]])
        n = np.concatenate([np.frombuffer(x, kind) for x in rows["n"]]).astype(np.int64)
        keys, sums = _summed(low, n)
        return pd.DataFrame({"h": keys[sums >= min_count].astype(np.int64)})

    found = dictionary.mapInPandas(seen, "range long, low binary, n binary").groupBy("range").applyInPandas(add, "h long")
    return mark_table(found, "h", bits)


def counted_phrases(
    dictionary: DataFrame,
    sizes: tuple[int, ...],
    below: np.ndarray | None,
    below_size: int,
    min_count: int,
    bits: int = MARK_BITS,
) -> DataFrame:
    """``h``, ``check``, ``a`` and a chunk's ``id`` of every phrase of one of ``sizes`` words with ``a >= min_count``.

    ``below`` marks the frequent phrases of ``below_size`` words: a phrase is
    counted only where all of those inside it are marked, which no frequent
    phrase fails.  Most phrases of two words or more are rare even so: those
    that ``often`` does not mark are not exchanged.  Phrases are told apart by 96 bits.
    """
    context = dictionary.sparkSession.sparkContext
    shared = context.broadcast(below)
    known = context.broadcast(often(dictionary, sizes, below, below_size, min_count, bits) if below is not None else None)

    def given(phrases: tuple[np.ndarray, ...]) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("h", "check", "n", "id"), (phrases[0].view(np.int64), *phrases[1:]))))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        new = 0
        for batch in _batches(frames):
            for size, at, hashes in _places(batch, sizes, shared.value, below_size):
                if known.value is not None:
                    here = marked(known.value, hashes)
                    at, hashes = at[here], hashes[here]
                held.append((hashes, batch.checks(size, at), batch.weight[at], batch.id[batch.chunk[at]]))
                new += len(at)
            if new > HELD_PHRASES:
                held, new = [_counted(held)], 0
                if len(held[0][0]) > HELD_PHRASES:
                    yield given(held[0])
                    held = []
        if held:
            yield given(_counted(held))

    counted = dictionary.mapInPandas(count, "h long, check long, n long, id long")
    summed = counted.groupBy("h", "check").agg(F.sum("n").alias("a"), F.min("id").alias("id"))
    return settle(summed.filter(F.col("a") >= min_count), "frequent-phrases")


def frequent_phrases(
    dictionary: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, bits: int = MARK_BITS
) -> DataFrame:
    """``lang``, ``phrase``, ``words`` and ``a`` of every phrase of up to ``max_words`` words with ``a >= min_count``.

    Level by level, frequent phrases are counted, and marked by hash in a table
    of fixed size that says where longer ones can be; a fuller table only lets
    more be counted.  Each frequent phrase names one chunk that holds it, from
    which its letters are read at last.
    """
    found, below, below_size = None, None, 0
    for sizes in ((1,), (2,), (3,), tuple(range(4, max_words + 1))):
        sizes = tuple(s for s in sizes if s <= max_words)
        if not sizes:
            break
        counted = counted_phrases(dictionary, sizes, below, below_size, min_count, bits)
        below, below_size = mark_table(counted, "h", bits), sizes[-1]
        found = counted if found is None else found.unionByName(counted)
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            batch, out = Batch(frame), []
            wanted = {(i, p["h"], p["check"]): p["a"] for i, own in enumerate(frame["wanted"]) for p in own}
            hashes = np.array([h for _, h, _ in wanted], np.int64)
            for size in range(1, max_words + 1):
                at = np.flatnonzero(batch.begins(size))
                found = batch.hashes(size)[at].view(np.int64)
                near = np.isin(found, hashes)
                at, found = at[near], found[near]
                keys = zip(batch.chunk[at].tolist(), found.tolist(), batch.checks(size, at).tolist())
                for key, place in zip(keys, at.tolist()):
                    a = wanted.pop(key, None)
                    if a is not None:
                        out.append((batch.langs[key[0]], batch.phrase(place, size), size, a))
            yield pd.DataFrame(out, columns=["lang", "phrase", "words", "a"])

    holders = likely(dictionary, F.col("id"), found, F.col("id"))
    wanted = found.groupBy("id").agg(F.collect_list(F.struct("h", "check", "a")).alias("wanted"))
    texts = holders.join(wanted, "id").mapInPandas(read, "lang string, phrase string, words long, a long")
    # Two chunks of one id may both hold the phrase.
    return settle(texts.distinct(), "phrases")


def _cuts(phrases: DataFrame) -> DataFrame:
    """Each phrase of two words or more with every cut into a first part and a rest."""
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1).cast("long"), F.col("words") - 1)).alias("k")
    return (
        phrases.filter("words >= 2")
        .select("lang", "phrase", "words", "a", words.alias("_w"), cut)
        .select(
            "lang",
            "phrase",
            "words",
            "a",
            "k",
            F.array_join(F.slice("_w", F.lit(1), F.col("k").cast("int")), " ").alias("_left"),
            F.array_join(F.slice("_w", (F.col("k") + 1).cast("int"), F.col("words").cast("int")), " ").alias("_right"),
        )
    )


def collocations(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    trigger: int = TRIGGER,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` and ``cut`` of each language's best phrases.

    Texts are cut into chunks at windows whose content triggers it, and equal
    chunks become one entry of a dictionary with its frequency: a passage that
    many documents share is counted through once.  A phrase is counted in the
    chunk where it begins, with that chunk's frequency.  A phrase of ``a``
    occurrences scores ``1000 * a * n div (l * r)`` at its weakest cut, in exact
    decimals; it goes if a longer phrase holds it with no fewer occurrences.

    Null, empty and blank texts have no words; a null language is ``und``.
    Repeated rows count each time.  Without frequent phrases the result is
    empty.
    """
    dictionary = chunk_dictionary(documents, text, lang, trigger, max_words)
    totals = settle(_totals(dictionary), "words-by-language")
    phrases = frequent_phrases(dictionary, max_words, min_count)
    known = phrases.select("lang", "phrase", F.col("a").alias("_f"))
    left = known.select("lang", F.col("phrase").alias("_left"), F.col("_f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("_right"), F.col("_f").alias("r"))
    exact = {c: F.col(c).cast("decimal(20,0)") for c in ("a", "l", "r", "n")}
    score = F.expr("cast(1000 as decimal(4,0)) * _a * _n div (_l * _r)")
    scored = (
        _cuts(phrases)
        .join(left, ["lang", "_left"])
        .join(right, ["lang", "_right"])
        .join(totals, "lang")
        .withColumns({f"_{c}": exact[c] for c in exact})
        .withColumn("score", score)
    )
    weakest = F.min(F.struct("score", F.col("k").alias("cut"), "l", "r", "n"))
    best = scored.groupBy("lang", "phrase", "words", "a").agg(weakest.alias("w")).select("lang", "phrase", "words", "a", "w.*")
    # A longer phrase with no fewer occurrences has one of just one word more inside it, or is that one.
    inner = F.explode(
        F.array(
            F.array_join(F.slice(F.split("phrase", " "), F.lit(1), (F.col("words") - 1).cast("int")), " "),
            F.array_join(F.slice(F.split("phrase", " "), F.lit(2), (F.col("words") - 1).cast("int")), " "),
        )
    )
    longer = (
        phrases.filter("words >= 3")
        .select("lang", inner.alias("phrase"), F.col("a").alias("_longer"))
        .groupBy("lang", "phrase")
        .agg(F.max("_longer").alias("_longer"))
    )
    alone = best.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(F.col("_longer") < F.col("a"), F.lit(True)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = top_n_per_group(alone, ["lang"], order, top, spread_by=["phrase"], position="rank")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def _totals(dictionary: DataFrame) -> DataFrame:
    """``lang`` and ``n``, its words: each begins phrases of one chunk of its text."""
    return dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).alias("n"))
