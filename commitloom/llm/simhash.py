"""Near-duplicates by SimHash fingerprints and covering tables of bit masks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitloom.llm.components import component_labels
from commitloom.llm.rows import keyed_rows, row_key, shown_id
from commitloom.session import settle

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
# A bucket of more fingerprints is cut finer before its members meet.
BUCKET_SIZE = 1000
# After this many refinements at most 2**7 different fingerprints share a bucket.
LEVELS = 3


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a whole text, as a signed number; zero without a word."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(0, len(words) - shingle_words)
    spans = zip(starts[: last + 1].tolist(), ends[min(shingle_words, len(words)) - 1 :].tolist())
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle_words) for t in batch], dtype="int64")

    compute.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(compute, "long")(text)


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over ``bits`` such that any ``radius`` of them miss at least one mask altogether.

    Each bit gets a nonzero vector of ``radius + 1`` binary digits, and each
    nonzero vector v a mask: the bits whose vector has odd overlap with v.
    Any ``radius`` vectors leave a direction v orthogonal to all of them, so
    two numbers that differ in these bits only agree under the mask of v.
    """
    vectors = 2 ** (radius + 1) - 1
    given = [(bit, 1 + i % vectors) for i, bit in enumerate(bits)]
    return [sum(1 << bit for bit, own in given if (own & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _levels(radius: int) -> list[list[int]]:
    """Masks of each level; table t of a level is refined by tables t * k to t * k + k - 1 of the next."""
    levels = [covering_masks(list(range(BITS)), radius)]
    while len(levels) < LEVELS:
        levels.append(
            [mask | finer for mask in levels[-1] for finer in covering_masks([b for b in range(BITS) if not mask >> b & 1], radius)]
        )
    return levels


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _bucket_links(members: np.ndarray, radius: int) -> list[dict]:
    """Links that hold a bucket's near members together: at most one per member, never all pairs."""
    values = np.unique(members)
    bits, root = values.view(np.uint64), np.arange(len(values))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i in range(len(values) - 1):
        near = np.flatnonzero(np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= radius) + i + 1
        for j in near.tolist():
            a, b = top(i), top(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append({"a": int(values[i]), "b": int(values[j])})
    return links


def _linked(buckets: DataFrame, radius: int) -> DataFrame:
    def link(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([_bucket_links(np.asarray(m, np.int64), radius) for m in batch])

    link.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    linker = F.pandas_udf(link, "array<struct<a: long, b: long>>")
    return buckets.select(F.explode(linker("_members")).alias("l")).select("l.a", "l.b")


def near_links(values: DataFrame, radius: int = MAX_DISTANCE, bucket_size: int = BUCKET_SIZE) -> DataFrame:
    """Links ``a, b`` among the distinct numbers ``fp`` that join all pairs within ``radius`` bits.

    Every pair within the radius shares a bucket in some table.  Only buckets
    of two or more are gathered; one of more than ``bucket_size`` is spread
    over the next level's tables on its free bits first, which again cover
    every pair, so that no pair is lost.  On the last level the free bits bound
    a bucket.
    """
    levels = _levels(radius)
    tables = len(levels[0])
    rows, found = values.select("fp", F.lit(0).alias("_parent")), None
    for level in count():
        masks = F.array(*[F.lit(_signed(m)) for m in levels[level]])
        table = F.explode(F.sequence(F.col("_parent") * tables, F.col("_parent") * tables + tables - 1))
        spread = rows.select("fp", table.alias("_table")).withColumn(
            "_key", F.col("fp").bitwiseAND(F.get(masks, F.col("_table")))
        )
        sizes = settle(spread.groupBy("_table", "_key").agg(F.count("*").alias("_n")).filter("_n > 1"), "buckets")
        last = level == LEVELS - 1
        small = sizes if last else sizes.filter(F.col("_n") <= bucket_size)
        gathered = (
            spread.join(small.drop("_n"), ["_table", "_key"])
            .groupBy("_table", "_key")
            .agg(F.collect_list("fp").alias("_members"))
        )
        links = _linked(gathered, radius)
        found = links if found is None else found.unionByName(links)
        large = sizes.filter(F.col("_n") > bucket_size)
        if last or large.isEmpty():
            return found.distinct()
        rows = settle(
            spread.join(large.drop("_n"), ["_table", "_key"]).select("fp", F.col("_table").alias("_parent")), "hot-buckets"
        )


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    radius: int = MAX_DISTANCE,
) -> DataFrame:
    """``_id``, ``_hash``, ``fp``, ``_component`` and ``component_id`` of every row.

    Rows link when their fingerprints differ in at most ``radius`` bits.
    ``_component`` names a component by its smallest fingerprint and is its own
    alone; ``component_id`` is the smallest ``doc_id`` reachable, which several
    components share where ids are null or repeated.  Null, empty and blank
    texts have fingerprint zero and link like any other; a null id comes after
    all others.  Equal fingerprints meet as one: copies are counted before any
    shuffle, and only one member of each takes part in the search.  An empty
    table has no components.
    """
    rows = settle(
        documents.select(*row_key(doc_id, text), fingerprints(F.col(text), shingle_words).alias("fp")), "fingerprints"
    )
    firsts = settle(rows.groupBy("fp").agg(F.min("_id").alias("_first")), "first-ids")
    links = near_links(firsts.select("fp"), radius)
    labels = component_labels(settle(links, "near-links"))
    # Labels name fingerprints; the smallest document of a component is found over its members.
    members = firsts.join(labels, firsts["fp"] == labels["node"], "left").select(
        "fp", F.coalesce("label", "fp").alias("_component"), "_first"
    )
    smallest = settle(members.groupBy("_component").agg(F.min("_first").alias("component_id")), "components")
    placed = settle(members.join(smallest, "_component").select("fp", "_component", "component_id"), "placed")
    return rows.join(placed, "fp").select("_id", "_hash", "fp", "_component", "component_id")


def shown(found: DataFrame) -> DataFrame:
    return found.select(
        shown_id("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        shown_id("component_id").alias("component_id"),
    )


def drop_near_duplicates(documents: DataFrame, **options) -> DataFrame:
    """One row of each component, as it is: the smallest ``doc_id``, and of its rows the smallest text hash.

    Of rows equal in ``doc_id`` and text one stays, chosen by a hash of all its
    columns; it is chosen before the shuffle where it can be.  Rows with a null
    or repeated ``doc_id`` and unlike texts are documents of their own.  Null
    and empty texts are near copies of each other, and an empty table stays
    empty.
    """
    names = {k: options[k] for k in ("doc_id", "text") if k in options}
    found = near_duplicates(documents, **options)
    chosen = found.groupBy("_component").agg(F.min(F.struct("_id", "_hash")).alias("k")).select("k._id", "k._hash")
    kept = keyed_rows(documents, **names).join(chosen, ["_id", "_hash"])
    one = kept.groupBy("_id", "_hash").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row"))
    return one.select("_row.*")
