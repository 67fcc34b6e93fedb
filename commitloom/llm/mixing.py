"""Mixing sources to target weights by word budget."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commitloom.llm.rows import WORD_PATTERN, keyed_rows, row_key, shown_id
from commitloom.operators.ranking import number_in_group
from commitloom.session import settle

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
SEED = 7
# Words left to the knapsack at first, and at most: its table has as many cells, and one per word of the longest text.
KNAPSACK_WORDS = 2**16
LARGEST_KNAPSACK = 2**24
# Slices by hash that a source's documents of one length are numbered in.
SLICE_BITS = 12


def fill_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, words: int = KNAPSACK_WORDS) -> np.ndarray:
    """How many documents of each length to take so that their words come as near ``budget`` as can be.

    All but ``words`` of the budget is shared out alike over the lengths, and
    a bounded knapsack settles the rest with the documents not taken yet.  If
    it meets the budget, no choice is nearer.  If it does not, eight times as
    many words are left to it, until none is shared out before: then it has
    seen every sum there is.  Only a budget of more than ``LARGEST_KNAPSACK``
    words that no choice of those left meets can stay off by more than needed;
    it is then off by less than half of the longest text.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros_like(counts)
    if budget >= total:
        return counts.copy()
    unit = int(np.gcd.reduce(lengths[counts > 0]))
    least = min(budget % unit, unit - budget % unit)  # all sums are multiples of it
    best, off = counts, total - budget
    while True:
        taken = _shared_out(lengths, counts, budget - words)
        taken += _knapsack(lengths, counts - taken, budget - int((lengths * taken).sum()))
        now = abs(int((lengths * taken).sum()) - budget)
        if now < off:
            best, off = taken, now
        if off == least or words >= min(budget, LARGEST_KNAPSACK):
            return best.copy()
        words *= 8


def _shared_out(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """The same share of every length, then long texts until the next would pass the budget."""
    if budget <= 0:
        return np.zeros_like(counts)
    total = int((lengths * counts).sum())
    taken = np.array([int(n) * budget // total for n in counts.tolist()], np.int64)
    left = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if lengths[i] > 0:
            more = min(int(counts[i] - taken[i]), left // int(lengths[i]))
            taken[i] += more
            left -= more * int(lengths[i])
    return taken


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """The choice whose sum is nearest to ``budget``, the smaller sum of two.

    The table reaches past the budget by the longest text there is: of a
    larger sum, one text less would be as near or nearer.
    """
    taken = np.zeros_like(counts)
    usable = (counts > 0) & (lengths > 0)
    if not usable.any():
        return taken
    size = budget + int(lengths[usable].max()) + 1
    # reached[s]: number of the part (a length, some of its documents) that first made the sum s.
    reached = np.full(size, -1, np.int32)
    reached[0] = 0
    parts: list[tuple[int, int]] = [(0, 0)]
    made = np.zeros(size, bool)
    made[0] = True
    for i in np.flatnonzero(usable)[np.argsort(lengths[usable], kind="stable")].tolist():
        length, spare, step = int(lengths[i]), int(counts[i]), 1
        while spare > 0 and length < size:
            some = min(step, spare, (size - 1) // length)
            jump = length * some
            new = made[:-jump] & ~made[jump:]
            if new.any():
                at = np.flatnonzero(new) + jump
                reached[at] = len(parts)
                made[at] = True
                parts.append((i, some))
            spare -= some
            step *= 2
            if length * some > budget:
                break
        if made[budget]:
            break
    sums = np.flatnonzero(made)
    best = int(sums[np.abs(sums - budget).argmin()])
    while best:
        i, some = parts[reached[best]]
        taken[i] += some
        best -= int(lengths[i]) * some
    return taken


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``source``, ``source_size`` and ``target`` in words.

    Sources stand by code point, null last; weights repeat in that order.  A
    target stops at ``max_repeats`` times its source's words, and what is over
    goes to the others by weight, until none is above.  Each round is two sums
    over all sources.
    """
    numbered = number_in_group(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_all", F.lit(0)),
        ["_all"],
        [F.col("source").asc_nulls_last()],
        "_place",
    )
    turn = F.pmod(F.col("_place") - 1, F.lit(len(weights))).cast("int")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), turn)
    sources = settle(
        numbered.select("source", "source_size", weight.alias("_weight"), (max_repeats * F.col("source_size")).alias("_most")),
        "sources",
    )
    total = total_share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        stopped = F.col("_most") <= level * F.col("_weight")
        row = sources.agg(
            F.coalesce(F.sum(F.when(stopped, F.col("_most"))), F.lit(0)).alias("full"),
            F.coalesce(F.sum(F.when(~stopped, F.col("_weight"))), F.lit(0)).alias("open"),
        ).first()
        higher = (total - row["full"]) / row["open"] if row["open"] else level
        if higher <= level:
            break
        level = higher
    target = F.least(F.col("_most").cast("double"), F.lit(float(level)) * F.col("_weight"))
    return settle(sources.select("source", "source_size", target.alias("target")), "targets")


def _fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
    passes = int(target // size) if size else 0
    more = fill_budget(rows["size"].to_numpy(), rows["n"].to_numpy(), round(target - passes * size))
    return pd.DataFrame({"source": rows["source"], "size": rows["size"], "passes": passes, "more": more})


def mix(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """``_id``, ``_hash``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of every row.

    A document's size is its number of words; null and empty texts have none.
    Whole passes over a source are taken while they fit its target; how many
    documents of each length come on top is a subset-sum over the counts per
    length, which no source has more of than its words allow.  Which ones is
    settled by a seeded hash of ``doc_id`` and text: documents of one length are
    counted in slices of the hash, so a source with a third of all rows is many
    groups, and only in the slice where a length's quota ends are they numbered.
    Rows equal in ``doc_id`` and text are counted as one there.  Rows that
    repeat a ``doc_id``, or have none, are documents of their own; a null
    source is a source and stands last.  An empty table gives an empty mix.
    """
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    # A source without a name cannot be joined on; it is given one that no source has.
    named = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source")).alias("_source")
    rows = settle(
        documents.select(
            *row_key(doc_id, text),
            F.col(source).cast("string").alias("source"),
            words.alias("size"),
            F.spark_partition_id().alias("_part"),
        ).select("*", named, F.xxhash64(F.lit(seed), "_id", "_hash").alias("_mark")),
        "sizes",
    ).withColumn("_slice", F.shiftrightunsigned("_mark", 64 - SLICE_BITS))
    targets = source_targets(rows, weights, total_share, max_repeats)
    slices = settle(rows.groupBy("source", "_source", "size", "_slice").agg(F.count("*").alias("_n")), "length-slices")
    known = F.col("t.source").eqNullSafe(F.col("s.source"))
    lengths = slices.groupBy("source", "size").agg(F.sum("_n").alias("n"))
    with_target = lengths.alias("s").join(targets.alias("t"), known).select("s.*", "t.source_size", "t.target")
    picks = settle(
        with_target.groupBy("source").applyInPandas(_fill, "source string, size long, passes int, more long"), "picks"
    )
    of_length, of_slice, of_row = ["_source", "size"], ["_source", "size", "_slice"], ["_source", "size", "_id", "_hash"]
    quota = settle(
        slices.join(picks.select(named, "size", "passes", "more"), of_length).select(
            *of_slice, "passes", _share("more", "_n", of_length, ["_slice"]), "_n"
        ),
        "quotas",
    )
    # One slice of a length at most is taken in part, and of the rows there one key at most.
    ending = rows.join(quota.filter("0 < _given and _given < _n").drop("_n"), of_slice)
    keys = ending.groupBy(*of_slice, "_given", "_mark", "_id", "_hash").agg(F.count("*").alias("_n"))
    parted = settle(
        keys.select(*of_row, "_n", _share("_given", "_n", of_slice, ["_mark", "_id", "_hash"])).withColumnRenamed("_given", "_own"),
        "ending-slices",
    )
    last = parted.filter("0 < _own and _own < _n").drop("_n")
    numbered = _first_rows(ending.drop("_given").join(last, of_row), of_row, "_own")
    plain = (
        rows.join(quota, of_slice)
        .join(parted.withColumnRenamed("_n", "_rows"), of_row, "left")
        .filter("not coalesce(0 < _own and _own < _rows, false)")
        .withColumn("_more", F.when(F.col("_own").isNotNull(), F.col("_own") > 0).otherwise(F.col("_given") > 0))
    )
    columns = [*of_row, (F.col("passes") + F.col("_more").cast("int")).alias("copies")]
    chosen = plain.select(*columns).unionByName(numbered.select(*columns))
    return chosen.join(targets.select(named, "source_size", "target"), "_source").select(
        "_id", "_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _share(quota: str, rows: str, group: list[str], order: list[str]) -> Column:
    """``_given``: of a group's ``quota``, what falls to a member of ``rows`` rows when those before it are served first."""
    before = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col(quota) - F.coalesce(F.sum(rows).over(before), F.lit(0))
    return F.greatest(F.lit(0), F.least(F.col(rows), left)).alias("_given")


def _first_rows(rows: DataFrame, key: list[str], wanted: str) -> DataFrame:
    """``rows`` with ``_more``, true for ``wanted`` many of each key, which may hold any share of all rows.

    They are numbered within the part (``_part``, fixed in a written table)
    that they came from, after the rows of earlier parts.
    """
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*key, "_part").agg(F.count("*").alias("_n"))
    offsets = parts.select(*key, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy(*key, "_part").orderBy(F.lit(1)))
    numbered = rows.withColumn("_nth", nth).join(offsets, [*key, "_part"])
    return numbered.withColumn("_more", F.col("_before") + F.col("_nth") <= F.col(wanted))


def shown(mixed: DataFrame) -> DataFrame:
    return mixed.select(shown_id("_id").alias("doc_id"), "size", "source_size", "target", "taken")


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, as it is.

    Rows equal in ``doc_id`` and text share out the copies they were given
    together.  Null and empty texts have no words; as many of them are taken as
    fill nothing.  An empty table stays empty.
    """
    names = {k: options[k] for k in ("doc_id", "text") if k in options}
    given = settle(
        mix(documents, **options)
        .groupBy("_id", "_hash")
        .agg(F.count("*").alias("_rows"), F.sum("copies").alias("_copies"))
        .select("*", F.floor(F.col("_copies") / F.col("_rows")).alias("_each"))
        .select("_id", "_hash", "_each", (F.col("_copies") - F.col("_each") * F.col("_rows")).alias("_rest")),
        "copies",
    )
    joined = keyed_rows(documents, **names).join(given.filter("_each + _rest > 0"), ["_id", "_hash"])
    # Only equal rows that cannot share evenly are numbered; they are written first, so that their parts stand.
    uneven = settle(joined.filter("_rest > 0").withColumn("_part", F.spark_partition_id()), "uneven-rows")
    numbered = _first_rows(uneven, ["_id", "_hash"], "_rest")
    own = [
        joined.filter("_rest = 0").select("_row", F.col("_each").alias("_own")),
        numbered.select("_row", (F.col("_each") + F.col("_more").cast("int")).alias("_own")),
    ]
    rows = own[0].unionByName(own[1]).filter("_own > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_own").cast("int"))).alias("_time")).select("_row.*")
