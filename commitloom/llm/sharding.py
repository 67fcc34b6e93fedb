"""Shards of nearly equal bytes by histogram sort."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commitloom.llm.rows import document_id, shown_id, whole_rows
from commitloom.session import settle

SHARDS = 8
# A splitter is settled when the bytes below it are this near to its target, as a share of a shard.
TOLERANCE = 0.001
PROBES = 512
# Rows of a shard are numbered in stretches of about this many.
STRETCH_ROWS = 1_000_000
SLICE_BITS = 6
LOWEST = -(2**63)
HIGHEST = 2**63 - 1


@dataclass(frozen=True)
class Splitter:
    """Rows at or above it, by the two keys in turn, belong to the next shard."""

    first: int
    second: int = LOWEST


@dataclass
class _Search:
    """What is known of one splitter: it lies in ``low`` to ``high`` of the second key if ``first`` is settled, else of the first."""

    target: float
    below: int  # bytes below the interval
    first: int | None = None
    low: int = LOWEST
    high: int = HIGHEST
    settled: Splitter | None = None

    def width(self) -> int:
        return max(1, -(-(self.high - self.low + 1) // PROBES))


def _probe(search: _Search) -> Column:
    """Number of the stretch between two probes that a row's key falls into; null outside the interval."""
    key = F.col("_k1") if search.first is None else F.col("_k2")
    inside = (key >= search.low) & (key <= search.high)
    if search.first is not None:
        inside = inside & (F.col("_k1") == search.first)
    if search.high - search.low < HIGHEST:
        offset, width = key - search.low, search.width()
    else:  # half of each: the difference then fits a long
        offset, width = F.shiftright(key, 1) - (search.low >> 1), search.width() >> 1
    return F.when(inside, F.floor(offset / width).cast("int"))


def find_splitters(
    keyed: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE
) -> list[Splitter]:
    """Splitters over ``_k1``, ``_k2`` that cut ``_size`` into ``shards`` nearly equal parts.

    Every round counts, in one aggregation, the exact bytes between evenly
    spaced probes of all open intervals, and narrows each interval to the
    stretch where its target falls, until a probe meets the target within
    ``tolerance``.  The interval also shrinks to the keys that occur.  One
    value of the first key that holds more than a shard is cut by the second.
    What comes to the driver is at most ``PROBES`` numbers per splitter.
    """
    ends = keyed.agg(
        F.sum("_size").alias("total"), F.min("_k1").alias("low"), F.max("_k1").alias("high")
    ).first()
    if not ends["total"]:
        return [Splitter(HIGHEST, HIGHEST)] * (shards - 1)
    share = ends["total"] / shards
    searches = [_Search(share * i, 0, None, ends["low"], ends["high"]) for i in range(1, shards)]
    while any(s.settled is None for s in searches):
        open_ones = [(i, s) for i, s in enumerate(searches) if s.settled is None]
        # Intervals that are the same are counted once.
        groups: dict[tuple, list[_Search]] = {}
        for _, s in open_ones:
            groups.setdefault((s.first, s.low, s.high), []).append(s)
        each = list(groups.values())
        marks = F.array(*[F.struct(F.lit(i).alias("g"), _probe(g[0]).alias("p")) for i, g in enumerate(each)])
        key = F.when(F.get(F.array(*[F.lit(g[0].first is None) for g in each]), F.col("m.g")), F.col("_k1")).otherwise(
            F.col("_k2")
        )
        counted = (
            keyed.select("_k1", "_k2", "_size", F.explode(F.filter(marks, lambda m: m["p"].isNotNull())).alias("m"))
            .groupBy("m.g", "m.p")
            .agg(F.sum("_size").alias("bytes"), F.min(key).alias("low"), F.max(key).alias("high"))
            .collect()
        )
        for number, group in enumerate(each):
            stretches = sorted((r for r in counted if r["g"] == number), key=lambda r: r["p"])
            for search in group:
                _narrow(search, stretches, tolerance * share)
    return [s.settled for s in searches]


def _narrow(search: _Search, stretches: list, near: float) -> None:
    """Move on to the stretch that holds the target, or settle the splitter at one of its ends."""
    below = search.below
    for stretch in stretches:
        after = below + stretch["bytes"]
        last = stretch is stretches[-1]
        if after < search.target and not last:
            below = after
            continue

        def at(value: int) -> Splitter:
            return Splitter(value) if search.first is None else Splitter(search.first, value)

        over, under = abs(after - search.target), abs(search.target - below)
        single = stretch["low"] == stretch["high"]
        if min(over, under) <= near or (single and search.first is not None):
            if under <= over:
                search.settled = at(stretch["low"])
            else:
                search.settled = at(stretch["high"] + 1) if stretch["high"] < HIGHEST else at(stretch["high"])
        elif single:
            search.first, search.low, search.high, search.below = stretch["low"], LOWEST, HIGHEST, below
        else:
            search.low, search.high, search.below = stretch["low"], stretch["high"], below
        return


def shard_of(splitters: list[Splitter]) -> Column:
    number = F.lit(0)
    for splitter in splitters:
        above = (F.col("_k1") > splitter.first) | (
            (F.col("_k1") == splitter.first) & (F.col("_k2") >= splitter.second)
        )
        number = number + above.cast("int")
    return number


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _keyed(documents: DataFrame, doc_id: str, text: str, *payload: Column) -> DataFrame:
    """The sort keys, a hash of the text and one of the ``doc_id``, and the size."""
    first, second = F.xxhash64(F.col(text)), F.xxhash64(document_id(doc_id))
    return documents.select(
        first.alias("_k1"), second.alias("_k2"), size_of(F.col(text)).alias("_size"), *payload
    )


def _place(rows: DataFrame, keys: DataFrame, shards: int, tolerance: float) -> DataFrame:
    """``rows`` with ``_shard`` and ``_slot``; ``keys`` holds the keys and sizes of the same rows."""
    keys = settle(keys, "keys")
    splitters = find_splitters(keys, shards, tolerance)
    n, bits = keys.count(), 5
    while n >> bits > STRETCH_ROWS:
        bits += 1

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "_shard": shard_of(splitters),
                "_stretch": F.shiftright("_k1", 64 - bits),
                # Of one stretch, slices by the second key: a hot text is many of them.
                "_slice": F.shiftright("_k2", 64 - SLICE_BITS),
            }
        )

    stretch = ["_shard", "_stretch", "_slice"]
    before = Window.partitionBy("_shard").orderBy("_stretch", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(
        placed(keys)
        .groupBy(*stretch)
        .agg(F.count("*").alias("_rows"))
        .select(*stretch, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")),
        "offsets",
    )
    nth = F.row_number().over(Window.partitionBy(*stretch).orderBy("_k1", "_k2"))
    return (
        placed(rows)
        .withColumn("_nth", nth)
        .join(offsets, stretch)
        .withColumn("_slot", (F.col("_offset") + F.col("_nth") - 1).cast("long"))
    )


def shard(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``documents`` with ``size``, ``shard`` and ``slot``; a column of theirs with such a name gives way.

    The order is by a hash of the text, then of the ``doc_id``: equal texts
    stand together, and only a splitter inside their group parts them.  A size
    is the bytes of the text plus one; null text has none.  Splitters are found
    on sizes and hashes alone, written once as a narrow table; then the rows
    are exchanged once, to stretches of their shard, and numbered there from
    the exact row counts of the stretches before.  Rows equal in text and
    ``doc_id`` stay together.  Null and empty texts are one byte each, a null id
    comes after all others, and an empty table gives no row.
    """
    rows = _keyed(documents, doc_id, text, whole_rows(documents))
    placed = _place(rows, _keyed(documents, doc_id, text), shards, tolerance)
    kept = [c for c in documents.columns if c not in ("size", "shard", "slot")]
    return placed.select(
        *[F.col(f"_row.`{c}`") for c in kept],
        F.col("_size").alias("size"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
    )


def placements(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Where every row goes: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    Only keys, size and checksum travel; null text has the checksum of none.
    """
    checksum = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("_checksum")
    rows = _keyed(documents, doc_id, text, document_id(doc_id).alias("_id"), checksum)
    placed = _place(rows, _keyed(documents, doc_id, text), shards, tolerance)
    return placed.select(
        shown_id("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_checksum").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(documents: DataFrame, path: str, **options) -> None:
    """The rows as one folder of files per shard; large shards are written by many tasks."""
    shard(documents, **options).write.partitionBy("shard").parquet(path)
