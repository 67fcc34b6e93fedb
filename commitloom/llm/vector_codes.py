"""Compact codes of vectors: per part a codebook of 16 entries, fitted in whole numbers over Hilbert-sorted blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitloom.llm.rows import document_id, shown_id
from commitloom.session import settle

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Members of a block: fewer make tighter boxes, more make fewer boxes.
BLOCK = 64
# Blocks that are kept as one row of the table of blocks.
PAGE_BLOCKS = 256
# Beyond this, squares summed over a vector could pass 64 bits; such components end the job with a message.
MAX_COMPONENT = 2**26
_KEY_BITS = 63


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point on the Hilbert curve through the grid of ``bits`` bits a dimension.

    The coordinates' bits are untangled level by level: where a coordinate's
    bit is set, lower bits of the first are flipped, else they are exchanged
    with its own; a Gray code over the dimensions and interleaving end it.
    """
    x = points.astype(np.uint64).T.copy()
    n, one = len(x), np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(n):
            is_set = (x[i] & bit) != 0
            swap = np.where(is_set, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[i] ^= swap if i else np.uint64(0)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        flips ^= np.where((x[-1] & bit) != 0, bit - one, np.uint64(0))
    x ^= flips
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(level)) & one)
    return key.astype(np.int64)


def box_distances(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance from each box to each entry."""
    below, above = low[:, None, :] - entries[None], entries[None] - high[:, None, :]
    outside = np.maximum(np.maximum(below, above), 0)
    farthest = np.maximum(np.abs(below), np.abs(above))
    return (outside * outside).sum(2), (farthest * farthest).sum(2)


def nearest(members: np.ndarray, block_of: np.ndarray, allowed: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each member, looking at its block's shortlist only; ties to the lower entry."""
    best = np.full(len(members), np.iinfo(np.int64).max)
    code = np.zeros(len(members), np.int64)
    for e in range(len(entries)):
        at = np.flatnonzero(allowed[block_of, e])
        away = members[at] - entries[e]
        distance = np.einsum("ij,ij->i", away, away)
        closer = distance < best[at]
        code[at[closer]], best[at[closer]] = e, distance[closer]
    return code, best


@dataclass(frozen=True)
class Page:
    """Blocks of one part position: members one after the other, and per block its box, sum and count."""

    members: np.ndarray
    counts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    FIELDS = ("members", "counts", "low", "high", "sums")

    @staticmethod
    def of(members: np.ndarray) -> Page:
        begins = np.arange(0, len(members), BLOCK)
        counts = np.diff(np.append(begins, len(members)))
        found = (f.reduceat(members, begins, axis=0) for f in (np.minimum, np.maximum, np.add))
        return Page(members, counts, *found)

    @staticmethod
    def read(row: pd.Series, width: int) -> Page:
        tables = [np.frombuffer(row[f], "<i8" if f == "sums" else "<i4").astype(np.int64) for f in Page.FIELDS]
        return Page(tables[0].reshape(-1, width), tables[1], *(t.reshape(-1, width) for t in tables[2:]))

    def written(self) -> list[bytes]:
        return [getattr(self, f).astype("<i8" if f == "sums" else "<i4").tobytes() for f in self.FIELDS]

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """Per block, the entries that can be nearest to a point of its box, or tie."""
        least, largest = box_distances(self.low, self.high, entries)
        return least <= largest.min(1, keepdims=True)

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per entry, the sum and count of the members nearest to it.

        A block with one entry on its list is added whole by its stored sum.
        """
        lists = self.shortlists(entries)
        single = lists.sum(1) == 1
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        owner = lists.argmax(1)
        np.add.at(sums, owner[single], self.sums[single])
        np.add.at(counts, owner[single], self.counts[single])
        block_of = np.repeat(np.arange(len(self.counts)), self.counts)
        open_members = ~single[block_of]
        members = self.members[open_members]
        code, _ = nearest(members, block_of[open_members], lists, entries)
        np.add.at(sums, code, members)
        np.add.at(counts, code, 1)
        return sums, counts

    def assigned(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        block_of = np.repeat(np.arange(len(self.counts)), self.counts)
        return nearest(self.members, block_of, self.shortlists(entries), entries)


def kept_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``_id``, ``_label`` and ``_v`` (whole numbers) of the rows whose vector is whole and finite."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    # NaN is greater than any number here, so one comparison finds it and both infinities.
    whole = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    number = F.transform(
        values,
        lambda x: F.when(F.abs(x * SCALE) < MAX_COMPONENT, F.floor(x * SCALE).cast("int")).otherwise(
            F.raise_error(F.lit(f"a component times {SCALE} reaches {MAX_COMPONENT}")).cast("int")
        ),
    )
    rows = vectors.select(document_id(vec_id).alias("_id"), F.col(label).alias("_label"), F.col(vector), values.alias("_values"))
    return rows.filter(F.coalesce(whole, F.lit(False))).select("_id", "_label", number.alias("_v"))


def first_codebooks(kept: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids (then the smallest vectors); none if they cannot be cut."""
    first = kept.orderBy("_id", "_v").select("_v").first()
    width, rest = divmod(len(first["_v"]) if first else 0, parts)
    if not width or rest:
        return []
    rows = kept.filter(F.size("_v") == width * parts).orderBy("_id", "_v").limit(entries).select("_v").collect()
    table = np.array([row["_v"] for row in rows], np.int64)
    return [table[:, p * width : (p + 1) * width] for p in range(parts)]


def _part_rows(batches: Iterator[pd.DataFrame], parts: int, width: int, low: int, high: int) -> Iterator[pd.DataFrame]:
    """One row per part: its position, its place on the curve, its vector's name and its numbers."""
    used = min(width, _KEY_BITS)
    bits = min(_KEY_BITS // used, max(1, int(high - low).bit_length()))
    shift = max(0, int(high - low).bit_length() - bits)
    for batch in batches:
        if not len(batch):
            continue
        table = np.stack(batch["_v"].to_list()).astype(np.int64)
        for p in range(parts):
            part = table[:, p * width : (p + 1) * width]
            keys = hilbert_keys((part[:, :used] - low) >> shift, bits)
            cells = part.astype("<i4")
            yield pd.DataFrame(
                {"part": np.int8(p), "key": keys, "_id": batch["_id"], "_hash": batch["_hash"], "v": [c.tobytes() for c in cells]}
            )


def _pages(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Pages of consecutive parts; a page ends with its batch or its part position."""
    for batch in batches:
        for part, rows in batch.groupby("part", sort=True):
            members = np.frombuffer(b"".join(rows["v"]), "<i4").astype(np.int64).reshape(-1, width)
            ids, hashes = rows["_id"].to_numpy("<i8"), rows["_hash"].to_numpy("<i8")
            out = []
            for at in range(0, len(members), BLOCK * PAGE_BLOCKS):
                to = at + BLOCK * PAGE_BLOCKS
                out.append((part, *Page.of(members[at:to]).written(), ids[at:to].tobytes(), hashes[at:to].tobytes()))
            yield pd.DataFrame(out, columns=["part", *Page.FIELDS, "ids", "hashes"])


PAGE_SCHEMA = ", ".join(["part byte", *(f"{name} binary" for name in (*Page.FIELDS, "ids", "hashes"))])


def block_pages(kept: DataFrame, width: int, parts: int = PARTS) -> DataFrame:
    """The table of blocks: parts in the order of the curve, dealt out by ranges of it.

    The range key ends with the vector's hash and id, so that any number of
    equal parts is spread over tasks like other parts.
    """
    row = kept.agg(F.min(F.array_min("_v")).alias("low"), F.max(F.array_max("_v")).alias("high")).first()
    low, high = row["low"], row["high"]
    spread = kept.select("_id", "_hash", "_v").mapInPandas(
        lambda batches: _part_rows(batches, parts, width, low, high), "part byte, key long, _id long, _hash long, v binary"
    )
    order = ["part", "key", "_hash", "_id"]
    dealt = spread.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(dealt.mapInPandas(lambda batches: _pages(batches, width), PAGE_SCHEMA), "vector-blocks")


def refine(pages: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every part goes to its nearest entry, every used entry to the floor of its parts' mean.

    A task returns one row of sums per page and entry; Spark adds them up, and
    the driver receives as many rows as there are entries.
    """
    width = codebooks[0].shape[1]
    shared = pages.sparkSession.sparkContext.broadcast(codebooks)

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for _, row in batch.iterrows():
                sums, counts = Page.read(row, width).totals(shared.value[row["part"]])
                out += [(row["part"], e, sums[e].tolist(), int(counts[e])) for e in np.flatnonzero(counts).tolist()]
            yield pd.DataFrame(out, columns=["part", "entry", "sums", "n"])

    read = pages.select("part", *Page.FIELDS).mapInPandas(totals, "part byte, entry int, sums array<long>, n long")
    exact = [F.sum(F.get("sums", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    moved = [book.copy() for book in codebooks]
    for row in read.groupBy("part", "entry").agg(F.sum("n").alias("n"), *exact).collect():
        moved[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    shared.unpersist()
    return moved


def _codes(pages: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """``_id``, ``_hash``, ``code`` and ``error`` of every different vector."""
    width = codebooks[0].shape[1]
    shared = pages.sparkSession.sparkContext.broadcast(codebooks)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                code, error = Page.read(row, width).assigned(shared.value[row["part"]])
                ids, hashes = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["hashes"], "<i8")
                yield pd.DataFrame({"_id": ids, "_hash": hashes, "part": row["part"], "code": code, "error": error})

    each = pages.mapInPandas(assign, "_id long, _hash long, part byte, code byte, error long")
    def of(part: int, column: str) -> Column:
        # Rows equal in id and vector have the same parts; each position counts once.
        return F.max(F.when(F.col("part") == part, F.col(column).cast("long")))

    code = F.concat(*[F.lpad(F.lower(F.hex(of(p, "code"))), 2, "0") for p in range(PARTS)])
    error = sum((of(p, "error") for p in range(1, PARTS)), of(0, "error"))
    return each.groupBy("_id", "_hash").agg(code.alias("code"), error.alias("error"))


def codebooks_digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id``, ``label``, ``code`` and ``error`` of every kept row, and the codebooks.

    Each component counts as ``floor(4096 * x)``; vectors are cut into equal
    parts, and each part position has a codebook of up to ``ENTRIES`` entries,
    fewer where fewer rows are kept.  Parts are sorted along a Hilbert curve and
    held in flat blocks with their boxes and sums, written once; each round a
    block's box says which entries can be nearest, and only those are looked
    at.  All arithmetic is in whole numbers.

    Rows whose vector is null or holds a component that is null, NaN or
    infinite are left out; a null ``vec_id`` stands after all others and its
    rows are coded like any.  Rows that repeat an id are coded each by its own
    vector.  Vectors of another length than the first, or all of them if that
    length is no multiple of the number of parts, get null code and error; an
    empty table gives an empty result and no codebooks.
    """
    kept = settle(kept_vectors(vectors, vec_id, vector, label).withColumn("_hash", F.xxhash64("_v")), "kept-vectors")
    codebooks = first_codebooks(kept)
    named = kept.select("_id", "_hash", shown_id("_id").alias("vec_id"), F.col("_label").alias("label"))
    if not codebooks:
        return named.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), []
    width = codebooks[0].shape[1]
    pages = block_pages(kept.filter(F.size("_v") == width * PARTS), width)
    for _ in range(rounds):
        codebooks = refine(pages, codebooks)
    found = named.join(_codes(pages, codebooks), ["_id", "_hash"], "left")
    return found.select("vec_id", "label", "code", "error"), codebooks


def shown(coded: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """The codes with the error summed over equal labels (nulls together) and the codebooks' digest."""
    coded = settle(coded, "codes")
    by_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).cast("long").alias("label_error"))
    out = coded.alias("c").join(by_label.alias("l"), F.col("c.label").eqNullSafe(F.col("l.label")))
    digest: Column = F.lit(codebooks_digest(codebooks))
    return out.select("c.vec_id", "c.code", "c.error", "l.label_error", digest.alias("codebooks_sha256"))
