"""Awkward documents that every operator has to take, and small helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score int, _id string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, lang[, source]]) with further columns whose names operators use themselves."""
    full = [(*row, *[None] * (4 - len(row)), 1, "s", 2, "x") for row in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows() -> list[tuple]:
    return [
        (1, None, None, None),
        (2, "", "en", ""),
        (3, " \n\t ", "en", "a"),
        (4, "one two three four", "en", "a"),
        (5, "one two three four", "en", "a"),
        (5, "one two three four", "en", "a"),
        (5, "other text under the same id", "en", None),
        (None, "no id at all", None, "b"),
        (6, "Grüße 𝒳 ünï \U0001f600 code | points", "de", "b"),
        (7, LONG, "en", "a"),
        (8, LONG + " tail", "en", "c"),
    ]


def collected(df: DataFrame) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]
