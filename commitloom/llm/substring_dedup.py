"""Repeated word windows between documents, by anchors at difference-cover positions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitloom.llm.marks import likely, mark_table, marked
from commitloom.llm.rows import row_key, shown_id
from commitloom.session import settle

WINDOW_WORDS = 50
PERIOD = 31
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(_BASE)
_BACK = np.uint64(pow(_BASE, -1, 2**64))


def difference_cover(period: int) -> list[int]:
    """A small set of residues whose differences are all residues, found greedily after trying perfect sets."""
    size = next(k for k in range(1, period + 1) if k * (k - 1) + 1 >= period)

    def extend(chosen: list[int], seen: frozenset[int]) -> list[int] | None:
        if len(chosen) == size:
            return chosen if len(seen) == period else None
        for nxt in range(chosen[-1] + 1, period):
            new = {(nxt - c) % period for c in chosen} | {(c - nxt) % period for c in chosen}
            if len(new) == 2 * len(chosen) and not new & seen:
                found = extend([*chosen, nxt], seen | new)
                if found:
                    return found
        return None

    if size * (size - 1) + 1 == period and (found := extend([0], frozenset([0]))):
        return found
    cover, seen = [0], {0}
    while len(seen) < period:
        best = max(
            (r for r in range(period) if r not in cover),
            key=lambda r: len({(r - c) % period for c in cover} | {(c - r) % period for c in cover} | seen),
        )
        seen |= {(best - c) % period for c in cover} | {(c - best) % period for c in cover}
        cover.append(best)
    return sorted(cover)


def joined_words(text: str | None) -> bytes:
    """The words with one space between them."""
    return b" ".join(text.encode("utf-8", "surrogatepass").split()) if text else b""


def _word_bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not joined:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    return np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(joined)]])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    made = np.full(n, base, np.uint64)
    if n:
        made[0] = 1
    return np.multiply.accumulate(made)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``values`` from prefix sums: the same numbers give the same hash anywhere."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_STEP, len(values)), dtype=np.uint64)])
    back = _powers(_BACK, len(values) + 1)
    return _mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def anchor_places(n_words: int, width: int, cover: list[int], period: int) -> np.ndarray:
    """Starts of anchors of ``width`` words: the places whose residue is in the cover, and the last place."""
    if n_words < width:
        return np.zeros(0, np.int64)
    residues = np.zeros(period, bool)
    residues[cover] = True
    residues = np.resize(residues, n_words - width + 1)
    residues[-1] = True
    return np.flatnonzero(residues)


def anchor_hashes(joined: bytes, window: int, cover: list[int], period: int) -> np.ndarray:
    starts, ends = _word_bounds(joined)
    if len(starts) < window:
        return np.zeros(0, np.int64)
    places = anchor_places(len(starts), window - period + 1, cover, period)
    words = _range_hashes(np.frombuffer(joined, np.uint8).astype(np.uint64) + np.uint64(1), starts, ends)
    return _range_hashes(words, places, places + window - period + 1).view(np.int64)


def extended(
    own: np.ndarray, first: np.ndarray, smaller: np.ndarray, number: np.ndarray, width: int, window: int
) -> list[tuple[int, int]]:
    """Stretches of words that an earlier document holds, by extension from anchor to anchor.

    Each shared anchor of a document stands at ``own`` and, in the first
    document that holds it (``number``, a ``smaller`` id or not), at ``first``.
    Anchors that follow each other with the same distance to the same document,
    and touch or overlap, are one longer match.  Returned are those of a window
    at least, as first word and word after the last.
    """
    if not len(own):
        return []
    breaks = (
        (own[1:] - own[:-1] > width)
        | (number[1:] != number[:-1])
        | (own[1:] - first[1:] != own[:-1] - first[:-1])
        | ~smaller[1:]
    )
    heads = np.flatnonzero(np.concatenate([[True], breaks]))
    tails = np.append(heads[1:], len(own)) - 1
    begins, ends = own[heads], own[tails] + width
    long = smaller[heads] & (ends - begins >= window)
    return list(zip(begins[long].tolist(), ends[long].tolist()))


def open_windows(n_words: int, places: np.ndarray, stretches: list[tuple[int, int]], width: int, window: int) -> np.ndarray:
    """Starts of the windows that hold an anchor at one of ``places`` and lie in none of the stretches."""
    change = np.zeros(n_words + 2, np.int64)
    np.add.at(change, np.maximum(places + width - window, 0), 1)
    np.add.at(change, places + 1, -1)
    wanted = np.cumsum(change) > 0
    for begin, end in stretches:
        wanted[begin : end - window + 1] = False
    starts = np.flatnonzero(wanted)
    return starts[starts <= n_words - window]


def _window_hashes(joined: bytes, found: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of the hashes of the windows that start at the words ``found``."""
    starts, ends = _word_bounds(joined)
    wide = xxhash.xxh3_128_digest
    spans = zip(starts[found].tolist(), ends[found + window - 1].tolist())
    digests = b"".join([wide(joined[a:b]) for a, b in spans])
    halves = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Numbers that follow each other as first and last."""
    if not len(starts):
        return []
    heads = np.flatnonzero(np.concatenate([[True], starts[1:] != starts[:-1] + 1]))
    return list(zip(starts[heads].tolist(), starts[np.append(heads[1:], len(starts)) - 1].tolist()))


def _without(joined: bytes, stretches, n_words: int) -> tuple[int, bytes]:
    change = np.zeros(n_words + 1, np.int64)
    for begin, end in stretches:
        change[begin] += 1
        change[end] -= 1
    gone = np.cumsum(change[:-1]) > 0
    words = joined.split(b" ")
    return int(gone.sum()), b" ".join([w for w, out in zip(words, gone.tolist()) if not out])


def _python(function, kind: str, *taken: type):
    """A pandas function over batches of one or several columns."""
    given = Iterator[pd.Series] if len(taken) < 2 else Iterator[tuple[taken]]
    function.__annotations__ = {"batches": given, "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(function, kind)


STRETCH = "struct<begin: int, end: int>"


def drop_repeated_windows(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW_WORDS,
    period: int = PERIOD,
    with_text: bool = False,
) -> DataFrame:
    """``_id``, ``_hash``, ``n_words``, ``n_removed``, ``kept_sha256`` and, on request, ``kept_text`` of every row.

    A word goes when it lies in a window of ``window`` words that also starts
    in a document with a smaller ``doc_id``.

    Anchors, shorter than a window by ``period - 1`` words, are hashed only
    where their place modulo the period is in a difference cover: two equal
    windows, wherever they stand, then hold the same anchor at the same offset.
    Each anchor that two documents share is joined to the first document that
    holds it, and matches are extended along it from anchor to anchor: whole
    copies and most of near copies are settled there.  What extension leaves
    open (matches at another distance modulo the period, their ends, and those
    with another than the first document) is settled by whole windows, hashed
    by 128 bits, and the smallest document of each.  The smallest holder of a
    window never has it inside an extended match, so it is always among them.

    Texts are read once for anchors; after that only those with an open window,
    or with a part to take out, are touched.  All steps count or take minima
    per hash, so nothing grows with the square of a group.

    Null and empty texts have no words.  Rows equal in id and text get the same
    result; rows that repeat an id hold nothing against each other, and neither
    do rows without an id, which come after all others.  An empty table gives
    an empty result.
    """
    cover, width = difference_cover(period), window - period + 1
    spark, key = documents.sparkSession, ["_id", "_hash"]

    def anchors_of(batches):
        for batch in batches:
            rows = []
            for one in batch:
                joined = joined_words(one)
                n = joined.count(b" ") + 1 if joined else 0
                rows.append((n, hashlib.sha256(joined).hexdigest(), anchor_hashes(joined, window, cover, period)))
            yield pd.DataFrame(rows, columns=["n_words", "sha", "anchors"])

    anchored = _python(anchors_of, "n_words long, sha string, anchors array<long>")
    rows = settle(
        documents.select(*row_key(doc_id, text), anchored(F.col(text)).alias("a")).select(*key, "a.*"), "anchors"
    )
    shared = settle(
        rows.select("_id", F.explode("anchors").alias("_anchor"))
        .groupBy("_anchor")
        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
        .filter(F.col("_first") < F.col("_last"))
        .select("_anchor"),
        "shared-anchors",
    )
    marks = spark.sparkContext.broadcast(mark_table(shared, "_anchor"))

    def shared_only(batches):
        for batch in batches:
            out = []
            for n, anchors in zip(batch["n_words"].tolist(), batch["anchors"]):
                at = np.flatnonzero(marked(marks.value, np.asarray(anchors, np.int64)))
                own = anchor_places(n, width, cover, period)[at].astype(np.int32)
                out.append((own, np.asarray(anchors, np.int64)[at]))
            columns = {c: batch[c] for c in (*key, "n_words")}
            yield pd.DataFrame({**columns, "at": [o[0] for o in out], "anchor": [o[1] for o in out]})

    thinned = rows.filter(F.size("anchors") > 0).select(*key, "n_words", "anchors")
    thinned = thinned.mapInPandas(shared_only, "_id long, _hash long, n_words long, at array<int>, anchor array<long>")
    places = settle(
        thinned.filter(F.size("at") > 0)
        .select(*key, "n_words", F.explode(F.arrays_zip("at", "anchor")).alias("a"))
        .select(*key, "n_words", "a.at", "a.anchor")
        .join(shared.withColumnRenamed("_anchor", "anchor"), "anchor"),
        "shared-places",
    )
    firsts = places.groupBy("anchor").agg(F.min(F.struct("_id", "_hash", "at")).alias("f"))
    place = F.struct(
        "at",
        "anchor",
        F.col("f.at").alias("first"),
        (F.col("f._id") < F.col("_id")).alias("smaller"),
        F.xxhash64("f._id", "f._hash").alias("number"),
    )

    def extend(batches):
        for batch, sizes in batches:
            out = []
            for one, n in zip(batch, sizes.tolist()):
                one = sorted(one, key=lambda p: p["at"])
                at, first = (np.array([p[c] for p in one], np.int64) for c in ("at", "first"))
                smaller, number = np.array([p["smaller"] for p in one], bool), np.array([p["number"] for p in one], np.int64)
                found = extended(at, first, smaller, number, width, window)
                # An anchor that lies deep in a stretch has all its windows there.
                inside = np.zeros(len(at), bool)
                for begin, end in found:
                    inside |= (np.maximum(at + width - window, 0) >= begin) & (np.minimum(at + window, n) <= end)
                left = [p["anchor"] for p, own, done in zip(one, smaller.tolist(), inside.tolist()) if own and not done]
                out.append((at.astype(np.int32), [p["anchor"] for p in one], [{"begin": a, "end": b} for a, b in found], left))
            yield pd.DataFrame(out, columns=["at", "anchor", "stretches", "open"])

    extension = _python(extend, f"at array<int>, anchor array<long>, stretches array<{STRETCH}>, open array<long>", *[pd.Series] * 2)
    matched = settle(
        places.join(firsts, "anchor")
        .groupBy(*key, "n_words")
        .agg(F.collect_set(place).alias("_places"))
        .select(*key, "n_words", extension("_places", "n_words").alias("m"))
        .select(*key, "n_words", "m.*"),
        "extended",
    )
    # Windows are looked at only around anchors that extension has left open in some document.
    still = settle(matched.select(F.explode("open").alias("anchor")).distinct(), "open-anchors")
    around = (
        matched.select(*key, F.explode(F.arrays_zip("at", "anchor")).alias("a"))
        .select(*key, "a.at", "a.anchor")
        .join(still, "anchor")
        .groupBy(*key)
        .agg(F.collect_set("at").alias("_around"))
    )
    searched = settle(
        around.join(matched.select(*key, "n_words", "stretches"), key).select(*key, "n_words", "stretches", "_around"), "searched"
    )
    keyed = documents.select(*row_key(doc_id, text), F.col(text).alias("text"))

    def texts_of(rows: DataFrame) -> DataFrame:
        """``rows`` with their texts: only a text that some row wants, or all but, is exchanged."""
        return likely(keyed, F.col("_hash"), rows, F.col("_hash")).join(rows, key)

    def windows_of(batches):
        for texts, sizes, stretches, around in batches:
            out = []
            for one, n, known, at in zip(texts, sizes.tolist(), stretches, around):
                known = [(s["begin"], s["end"]) for s in known]
                found = open_windows(n, np.asarray(at, np.int64), known, width, window)
                out.append((found.astype(np.int32), *_window_hashes(joined_words(one), found, window)))
            yield pd.DataFrame(out, columns=["at", "h1", "h2"])

    windowed = _python(windows_of, "at array<int>, h1 array<long>, h2 array<long>", *[pd.Series] * 4)
    # Rows equal in id and text repeat their windows here; that changes no minimum, and their starts are a set.
    windows = settle(
        texts_of(searched)
        .select(*key, windowed("text", "n_words", "stretches", "_around").alias("w"))
        .select(*key, F.explode(F.arrays_zip("w.at", "w.h1", "w.h2")).alias("w"))
        .select(*key, "w.*"),
        "windows",
    )
    repeated = settle(
        windows.groupBy("h1", "h2")
        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
        .filter(F.col("_first") < F.col("_last"))
        .drop("_last"),
        "repeated-windows",
    )

    def join_up(batches):
        for batch in batches:
            yield pd.Series([[{"begin": a, "end": b + window} for a, b in _runs(np.unique(one))] for one in batch])

    join_up.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    by_window = (
        likely(windows, F.col("h1"), repeated, F.col("h1"))
        .join(repeated, ["h1", "h2"])
        .filter(F.col("_id") > F.col("_first"))
        .groupBy(*key)
        .agg(F.collect_set("at").alias("_starts"))
        .select(*key, F.pandas_udf(join_up, f"array<{STRETCH}>")("_starts").alias("_stretches"))
    )
    by_extension = matched.filter(F.size("stretches") > 0).select(*key, F.col("stretches").alias("_stretches"))
    removed = settle(
        by_extension.unionByName(by_window).groupBy(*key).agg(F.flatten(F.collect_list("_stretches")).alias("_removed")), "removed"
    )
    # Of a text that goes whole nothing is left to read.
    whole = F.exists("_removed", lambda s: (s["begin"] == 0) & (s["end"] == F.col("n_words")))
    judged = rows.drop("anchors").join(removed, key, "left").withColumn("_whole", F.coalesce(whole, F.lit(False)))
    cut = judged.filter(F.col("_removed").isNotNull() & ~F.col("_whole")).select(*key, "n_words", "_removed").dropDuplicates(key)

    def kept_of(batches):
        for texts, sizes, removed in batches:
            out = []
            for one, n, stretches in zip(texts, sizes.tolist(), removed):
                gone, kept = _without(joined_words(one), [(s["begin"], s["end"]) for s in stretches], n)
                shown = kept.decode("utf-8", "surrogatepass") if with_text else None
                out.append((gone, hashlib.sha256(kept).hexdigest(), shown))
            yield pd.DataFrame(out, columns=["n_removed", "sha", "kept_text"])

    shortened = _python(kept_of, "n_removed long, sha string, kept_text string", *[pd.Series] * 3)
    changed = (
        texts_of(settle(cut, "cuts"))
        .select(*key, shortened("text", "n_words", "_removed").alias("k"))
        .groupBy(*key)
        .agg(F.first("k").alias("k"))
    )
    nothing = hashlib.sha256(b"").hexdigest()
    out = judged.drop("_removed").join(settle(changed, "shortened"), key, "left")
    columns = [
        *key,
        "n_words",
        F.when(F.col("_whole"), F.col("n_words")).otherwise(F.coalesce("k.n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("_whole"), F.lit(nothing)).otherwise(F.coalesce("k.sha", "sha")).alias("kept_sha256"),
    ]
    text_left = F.when(F.col("_whole"), F.lit("")).otherwise(F.col("k.kept_text")).alias("kept_text")
    return out.select(*columns, text_left) if with_text else out.select(*columns)


def shown(found: DataFrame) -> DataFrame:
    return found.select(shown_id("_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
