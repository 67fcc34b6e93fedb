"""Helpers the operators of this package share.

A document is named by its ``doc_id``, a whole number: a column of another
type has to be numbered first, and text that is no number ends the job with
Spark's message.  Where a decision has to find its way
back to the text, rows are named by ``doc_id`` and a hash of the text, so rows
that repeat a ``doc_id`` with another text stay apart; rows equal in both get
the same decision.  A null ``doc_id`` counts as one more document that comes
after all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_ID = 2**63 - 1
SPACE = b" \t\n\x0b\x0c\r"
# Fixed value: the separators of a word, one code point each.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def document_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column), F.lit(LAST_ID))


def shown_id(column: str) -> Column:
    return F.when(F.col(column) != LAST_ID, F.col(column))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """``_id`` and ``_hash``: what names a row."""
    return [document_id(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_hash")]


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case and nothing else; text that is all ASCII takes the fast way."""
    plain = F.octet_length(text) == F.length(text)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, letters, letters.lower()))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def whole_rows(df: DataFrame) -> Column:
    """All columns as one, ``_row``, so that no helper column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def keyed_rows(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_row`` and the two columns that name it."""
    return df.select(whole_rows(df), *row_key(doc_id, text))
