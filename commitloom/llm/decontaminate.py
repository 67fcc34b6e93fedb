"""Benchmark decontamination: benchmark word windows found in training text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitloom.llm.marks import mark_table, marked
from commitloom.llm.rows import keyed_rows, row_key, whole_rows
from commitloom.session import settle

WINDOW_WORDS = 13
# Most that the windows of a benchmark may take up, built, to be broadcast; those of a larger one are joined.
BUILT_BYTES = 64 * 1024 * 1024
# What a benchmark word takes up there at most: its number, its window's hashes, place and items, and its entry as a word.
WORD_BYTES = 320
# A word is a run of ASCII letters and digits and of all code points from 128 on.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A or 0x30 <= b <= 0x39 else 0x20
    for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def folded_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _hash_at(columns) -> np.ndarray:
    """A hash of each window, given as its first words, its second words, and so on."""
    rolled = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        rolled = rolled * _MIX + column
    return rolled ^ (rolled >> np.uint64(29))


@dataclass
class WindowSet:
    """The distinct windows of a benchmark: word numbers, and per width sorted hashes with the items of each."""

    names: list[str] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    # width -> hashes (sorted), place of the window in ``words``, where its items begin, and the items of all
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    @staticmethod
    def of(items: list[tuple[str, str]], width: int) -> WindowSet:
        made = WindowSet()
        numbers = made.vocabulary
        texts, places, offset = [], {}, 0
        for name, text in items:
            ids = np.array([numbers.setdefault(w, len(numbers) + 1) for w in folded_words(text)], np.uint64)
            if not len(ids):
                continue
            own = min(width, len(ids))
            at = offset + np.arange(len(ids) - own + 1)
            places.setdefault(own, []).append((at, np.full(len(at), len(made.names), np.int32)))
            made.names.append(name)
            texts.append(ids)
            offset += len(ids)
        made.words = np.concatenate(texts) if texts else made.words
        for own, each in places.items():
            at, of_item = (np.concatenate(x) for x in zip(*each))
            made.windows[own] = made._distinct(own, at, of_item)
        return made

    def _distinct(self, width: int, at: np.ndarray, of_item: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each different window once, by its hash, with its different items one after the other."""
        rows = self.words[at[:, None] + np.arange(width)]
        order = np.lexsort((of_item, *rows.T[::-1]))
        rows, at, of_item = rows[order], at[order], of_item[order]
        new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])
        fresh = new | np.concatenate([[True], of_item[1:] != of_item[:-1]])
        kept = np.cumsum(fresh)
        begins = kept[new] - 1
        sizes = np.diff(np.append(begins, kept[-1]))
        hashes = _hash_at(rows[new].T)
        by_hash = np.argsort(hashes, kind="stable")
        items = of_item[fresh]
        sizes, begins = sizes[by_hash], begins[by_hash]
        moved = np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        return hashes[by_hash], at[new][by_hash], np.concatenate([[0], np.cumsum(sizes)]), items[moved]

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Which words lie inside an occurrence of a window, and whose windows occur."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words], np.uint64)
        covered, found = np.zeros(len(ids) + 1, np.int64), []
        known = np.concatenate([[0], np.cumsum(ids != 0)])
        for width, (hashes, places, begins, items) in self.windows.items():
            if len(ids) < width:
                continue
            # Hashes only of the windows that consist of benchmark words.
            starts = np.flatnonzero(known[width:] - known[:-width] == width)
            if not len(starts):
                continue
            rolled = _hash_at([ids[starts + k] for k in range(width)])
            low = np.searchsorted(hashes, rolled, "left")
            while True:
                # Verify word by word, against every window with this hash.
                near = np.flatnonzero((low < len(hashes)) & (hashes[np.minimum(low, len(hashes) - 1)] == rolled))
                if not len(near):
                    break
                same = np.ones(len(near), bool)
                for k in range(width):
                    same &= self.words[places[low[near]] + k] == ids[starts[near] + k]
                at = starts[near[same]]
                np.add.at(covered, at, 1)
                np.add.at(covered, at + width, -1)
                which = np.unique(low[near[same]])
                found += [items[begins[w] : begins[w + 1]] for w in which.tolist()]
                low = low[near] + 1
                starts, rolled = starts[near], rolled[near]
        names = sorted({self.names[i] for i in np.unique(np.concatenate(found)).tolist()}) if found else []
        return np.cumsum(covered[:-1]) > 0, names


RESULT = "n_words long, items array<string>, spans array<struct<first: int, last: int>>"


def _runs(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2])]


def scan(spark: SparkSession, text: Column, windows: WindowSet) -> Column:
    """Struct of ``n_words``, ``items`` (ids) and ``spans`` (first and last word of each hit stretch)."""
    shared = spark.sparkContext.broadcast(windows)

    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            rows = []
            for one in batch:
                words = folded_words(one)
                mask, found = own.hits(words)
                rows.append((len(words), found, _runs(mask)))
            yield pd.DataFrame(rows, columns=["n_words", "items", "spans"])

    search.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(search, RESULT)(text)


def benchmark_items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """The different items, as ``item`` (empty where null) and ``text``."""
    item = F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item")
    return settle(benchmark.select(item, F.coalesce(F.col(text), F.lit("")).alias("text")).distinct(), "benchmark")


def built_bytes(items: DataFrame) -> int:
    """A bound of what the windows of the items take up when built."""
    words = F.regexp_count("text", F.lit(WORD_PATTERN))
    row = items.agg(F.sum(WORD_BYTES * words.cast("long") + F.octet_length("text") + F.octet_length("item")).alias("n")).first()
    return int(row["n"] or 0)


def _hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"] + 1))


def _windows_of(items: DataFrame, width: int) -> DataFrame:
    """``item``, ``size`` and ``window``, the words as text, of each item's windows."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"]):
                words = folded_words(text)
                size = min(width, len(words))
                windows = {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)} if words else ()
                rows += [(item, size, window, _window_hash(window)) for window in windows]
            yield pd.DataFrame(rows, columns=["item", "size", "window", "h"])

    return settle(items.mapInPandas(cut, "item string, size int, window binary, h long"), "benchmark-windows")


def _window_hash(window: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(window)
    return value - 2**64 if value >= 2**63 else value


def joined_hits(documents: DataFrame, items: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``_id``, ``_hash``, ``_items`` and ``_spans`` of the rows that hold a window, for a benchmark of any size.

    The windows' hashes are marked in a table of fixed size; document windows
    that it lets through meet the benchmark's in a join on their words.  A
    fuller table only lets more through.
    """
    spark, key = documents.sparkSession, ["_id", "_hash"]
    windows = _windows_of(items, width)
    sizes = sorted(row["size"] for row in windows.select("size").distinct().collect())
    marks = spark.sparkContext.broadcast(mark_table(windows, "h"))

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, h, one in zip(batch["_id"].tolist(), batch["_hash"].tolist(), batch["text"]):
                words = folded_words(one)
                joined = b" ".join(words)
                begins = np.cumsum([0, *(len(w) + 1 for w in words)])
                for size in sizes:
                    ends = begins[size:] - 1
                    found = [joined[a:b] for a, b in zip(begins.tolist(), ends.tolist())]
                    hashes = np.array([_window_hash(w) for w in found], np.int64)
                    at = np.flatnonzero(marked(marks.value, hashes)) if len(hashes) else hashes
                    if len(at):
                        rows = {"first": at, "last": at + size - 1, "size": size, "window": [found[k] for k in at.tolist()]}
                        yield pd.DataFrame({"_id": i, "_hash": h, **rows})

    rows = documents.select(*row_key(doc_id, text), F.col(text).alias("text")).filter("text is not null")
    near = rows.mapInPandas(candidates, "_id long, _hash long, first int, last int, size int, window binary")
    hits = settle(near.join(windows.select("size", "window").distinct(), ["size", "window"]).distinct(), "hits")
    items_of = (
        hits.select(*key, "size", "window")
        .distinct()
        .join(windows.select("size", "window", "item"), ["size", "window"])
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set("item")).alias("_items"))
    )

    def merge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_runs(_covered([(s["first"], s["last"]) for s in spans])) for spans in batch])

    merge.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    merged = F.pandas_udf(merge, "array<struct<first: int, last: int>>")
    spans_of = hits.groupBy(*key).agg(F.collect_set(F.struct("first", "last")).alias("s")).select(*key, merged("s").alias("_spans"))
    return settle(items_of.join(spans_of, key), "hits")


def _covered(spans: list[tuple[int, int]]) -> np.ndarray:
    change = np.zeros(max((last for _, last in spans), default=-1) + 2, np.int64)
    for first, last in spans:
        change[first] += 1
        change[last + 1] -= 1
    return np.cumsum(change) > 0


def with_hits(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW_WORDS,
    most_built: int = BUILT_BYTES,
) -> DataFrame:
    """Every row as ``_row``, with a struct ``_found`` of ``n_words``, ``items`` and ``spans``.

    A benchmark item of fewer than ``width`` words is one window; one without
    a word has none; a null id counts as the empty one.  Windows that take up
    ``most_built`` bytes at most, built, are broadcast and the documents pass
    once, without a shuffle.  Those of a larger benchmark are joined, and the
    hits, few and narrow, meet the documents by id and text.  Null and empty
    texts have no words and no hits; repeated rows, and those without an id,
    are judged each by its own text; with an empty benchmark nothing is hit.
    """
    spark = documents.sparkSession
    items = benchmark_items(benchmark, item_id, item_text)
    if built_bytes(items) <= most_built:
        built = WindowSet.of([(row["item"], row["text"]) for row in items.orderBy("item", "text").collect()], width)
        return documents.select(whole_rows(documents), scan(spark, F.col(text), built).alias("_found"))
    hits = joined_hits(documents, items, doc_id, text, width)
    counted = keyed_rows(documents, doc_id, text).withColumn("_found", scan(spark, F.col(f"_row.{text}"), WindowSet()))
    joined = counted.join(hits, ["_id", "_hash"], "left").withColumn(
        "_found",
        F.struct(
            F.col("_found.n_words").alias("n_words"),
            F.coalesce("_items", F.col("_found.items")).alias("items"),
            F.coalesce("_spans", F.col("_found.spans")).alias("spans"),
        ),
    )
    return joined.select("_row", "_found")


def _contaminated(found: str) -> Column:
    """One word in twenty, or more, is hit."""
    hit = _hit_words(F.col(f"{found}.spans"))
    return (hit > 0) & (20 * hit >= F.col(f"{found}.n_words"))


def find_contamination(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items``, ``spans`` and ``contaminated`` of every row."""
    text = options.get("text", "text")
    found = with_hits(documents.select(doc_id, text), benchmark, doc_id, **options)
    return found.select(
        F.col(f"_row.{doc_id}").alias(doc_id),
        "_found.n_words",
        _hit_words(F.col("_found.spans")).alias("n_hit"),
        "_found.items",
        "_found.spans",
        _contaminated("_found").alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Rows that are not contaminated, as they are."""
    found = with_hits(documents, benchmark, doc_id, **options)
    return found.filter(~_contaminated("_found")).select("_row.*")


def drop_hit_words(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """All rows, without the stretches of text from the first to the last character of each hit span."""
    text = options.get("text", "text")

    def cut(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in pairs:
            yield pd.Series([_without(t, s) for t, s in zip(texts, spans)], dtype=object)

    cut.__annotations__ = {"pairs": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    found = with_hits(documents, benchmark, doc_id, **options)
    shorter = F.pandas_udf(cut, "string")(F.col(f"_row.{text}"), F.col("_found.spans"))
    rest = [shorter.alias(c) if c == text else F.col(f"_row.`{c}`") for c in documents.columns]
    return found.select(*rest)


_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _without(text: str | None, spans) -> str | None:
    if text is None or not len(spans):
        return text
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(data.translate(_FOLD))]
    kept, at = [], 0
    for span in spans:
        kept.append(data[at : places[span["first"]][0]])
        at = places[span["last"]][1]
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")
