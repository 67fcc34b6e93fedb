"""A table of marks by hash: says of most things that they are not in a set, in memory that never grows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells of a table; a power of two.
MARK_BITS = 2**26


def mark_table(hashes: DataFrame, column: str, bits: int = MARK_BITS) -> np.ndarray:
    """A table of ``bits`` cells that holds every hash, and others by chance.

    Cells are put together where the hashes lie; at most ``bits / 64`` numbers
    come to the driver.
    """
    # The unsigned hash modulo a power of two is its low bits.
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")
    cells = (
        hashes.select(F.shiftright(slot, 6).alias("cell"), bit.alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    ).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return table.view(np.uint64)


def marked(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the set; always true of those that are."""
    slot = hashes.view(np.uint64) % np.uint64(64 * len(table))
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def likely(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """``df`` without most of the rows whose ``key`` (a long) is not in ``wanted``: what is left is worth a shuffle.

    Only keys go to Python; rows of wanted keys all stay, so a join afterwards
    gives what it would have given.
    """
    shared = df.sparkSession.sparkContext.broadcast(mark_table(wanted.select(wanted_key.alias("_key")), "_key"))

    def seen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(marked(shared.value, keys.to_numpy(np.int64)))

    seen.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.filter(F.pandas_udf(seen, "boolean")(key))
