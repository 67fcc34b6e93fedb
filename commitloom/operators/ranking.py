"""Ordered positions inside groups of any size.

A group may hold a large share of all rows, so no operator here sorts more than
``ONE_TASK_ROWS`` rows of a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commitloom.session import settle

# Slices a group is cut into before it is ranked.
SLICES = 128
# Most rows of one group that may meet in one task.
ONE_TASK_ROWS = 2_000_000
# A range partition is made for about this many rows.
CHUNK_ROWS = 1_000_000


def fits_one_task(n: int) -> bool:
    """Whether what the slices of a group leave of it, ``n`` rows each, may meet in one task."""
    return n * SLICES <= ONE_TASK_ROWS


def shortlist(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread_by: Sequence[str],
) -> DataFrame:
    """All rows that can be among the first ``n`` of their group, ``SLICES * n`` per group at most.

    A group is cut into hash slices of ``spread_by``, and each slice gives up
    all but its own first ``n`` rows, before the shuffle where it can.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*spread_by), F.lit(SLICES)).cast("int"))
    in_slice = Window.partitionBy(*group, "_slice").orderBy(*order)
    return sliced.withColumn("_place", F.row_number().over(in_slice)).filter(F.col("_place") <= n).drop("_slice", "_place")


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread_by: Sequence[str],
    position: str = "position",
) -> DataFrame:
    """First ``n`` rows of every group, numbered from 1 in ``position``."""
    in_group = Window.partitionBy(*group).orderBy(*order)
    return (
        shortlist(df, group, order, n, spread_by)
        .withColumn(position, F.row_number().over(in_group))
        .filter(F.col(position) <= n)
        .withColumn(position, F.col(position).cast("long"))
    )


def cut_into_chunks(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows with ``_chunk``, numbers that rise in group order, written to the shared folder when called.

    Range partitions cut a hot group into even chunks.  There are as many as
    the rows need, which are counted first, so no chunk grows with the data.
    The chunks are written out before use, so all who read them see the same
    cuts even when an executor is lost.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, -(-df.count() // CHUNK_ROWS))
    return settle(df.repartitionByRange(parts, *group, *order).withColumn("_chunk", F.spark_partition_id()), "chunks")


def chunk_offsets(chunked: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows of a group before each of its chunks; one narrow row per chunk and group."""
    earlier = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunked.groupBy(*group, "_chunk")
        .agg(F.count("*").alias("_rows"))
        .select(*group, "_chunk", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )


def split_by_size(df: DataFrame, group: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups that one task may hold, and those of larger groups: None if there are none.

    The larger groups, ``1 / ONE_TASK_ROWS`` of the rows at most, are listed in
    the shared folder when this is called.
    """
    sizes = df.groupBy(*group).agg(F.count("*").alias("_rows"))
    large = settle(sizes.filter(F.col("_rows") > ONE_TASK_ROWS).select(*group), "large-groups")
    if large.isEmpty():
        return df, None
    listed = F.broadcast(large.select(*[F.col(c).alias(f"_large_{c}") for c in group]))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_large_{c}")) for c in group])
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")


def number_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], position: str = "position"
) -> DataFrame:
    """Number all rows of every group from 1, with no bound on the group; rows without a group are left out.

    Groups that one task may hold meet in one shuffle.  In a larger one, a row's
    number is its place in its chunk plus the sizes of the group's earlier
    chunks.
    """
    small, large = split_by_size(df.dropna(subset=list(group)), group)
    in_group = F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long")
    numbered = small.withColumn(position, in_group).select(*df.columns, position)
    return numbered if large is None else numbered.unionByName(_number_in_chunks(large, group, order, position))


def _number_in_chunks(df: DataFrame, group: Sequence[str], order: Sequence[Column], position: str) -> DataFrame:
    chunked = cut_into_chunks(df, group, order)
    in_chunk = F.row_number().over(Window.partitionBy(*group, "_chunk").orderBy(*order))
    return (
        chunked.withColumn("_place", in_chunk)
        .join(chunk_offsets(chunked, group), [*group, "_chunk"])
        .withColumn(position, F.col("_offset") + F.col("_place"))
        .select(*df.columns, position)
    )


def first_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, spread_by: Sequence[str]
) -> DataFrame:
    """First ``n`` rows of every group with their ``position``, for any ``n``."""
    if fits_one_task(n):
        return top_n_per_group(df, group, order, n, spread_by)
    return number_in_group(df, group, order).filter(F.col("position") <= n)
