"""Lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitloom.llm.rows import ascii_lower, row_key, shown_id
from commitloom.session import settle

MIN_KEY_LENGTH = 10
MIN_DOCUMENTS = 2
_BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without outer blanks, A to Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(_BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _keyed_lines(documents: DataFrame, doc_id: str, text: str, min_length: int) -> DataFrame:
    """Lines long enough to count: their document, position and the hash of their key."""
    return (
        documents.select(*row_key(doc_id, text), F.posexplode(_lines(F.col(text))).alias("_at", "_line"))
        .select("_id", "_hash", "_at", line_key(F.col("_line")).alias("_key"))
        .filter(F.length("_key") >= min_length)
        .select("_id", "_hash", "_at", F.unhex(F.md5("_key")).alias("_line_hash"))
    )


def shared_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``_line_hash`` and the smallest document of every line found in ``min_documents`` or more."""
    if min_documents == 2:
        # Two documents hold it exactly when the smallest and the largest differ; no distinct count is needed.
        spread = lines.groupBy("_line_hash").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
        return spread.filter(F.col("_first") < F.col("_last")).drop("_last")
    once = lines.groupBy("_line_hash", "_id").agg(F.lit(1).alias("_one"))
    spread = once.groupBy("_line_hash").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    return spread.filter(F.col("_n") >= min_documents).drop("_n")


def drop_shared_lines(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_KEY_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and the kept ``text`` of every row.

    Lines whose key has ``min_length`` code points or more and is in
    ``min_documents`` documents or more stay in the smallest of these only.
    Null text is one empty line.  Rows that repeat an id are one document, and so
    are all rows without an id, which come after all others: their lines do not
    count against each other.  An empty table gives an empty result.  Lines travel as hashes: counts per hash are
    combined before the shuffle, and the lines to drop come back to their
    document as positions, from which the text is put together again.
    """
    lines = _keyed_lines(documents, doc_id, text, min_length)
    shared = settle(shared_lines(lines, min_documents), "shared-lines")
    drops = (
        lines.join(shared, "_line_hash")
        .filter(F.col("_id") != F.col("_first"))
        .groupBy("_id", "_hash")
        .agg(F.collect_set("_at").alias("_drops"))
    )
    drops = settle(drops, "line-drops")
    # Split before the join, so that the lines are at hand as a column; which stay is a set difference of positions.
    rows = documents.select(*row_key(doc_id, text), _lines(F.col(text)).alias("_lines"))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    stay = F.transform(F.array_except(every, "_drops"), lambda at: F.get(F.col("_lines"), at))
    kept = F.when(F.col("_drops").isNull(), F.col("_lines")).otherwise(stay)
    return rows.join(drops, ["_id", "_hash"], "left").select(
        shown_id("_id").alias("doc_id"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("_drops").isNull(), 0).otherwise(F.size("_drops")).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("text"),
    )
