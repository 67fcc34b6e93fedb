"""The normalisation stage: JSON lines in, JSON lines out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from commitloom import fixed_values as fv
from commitloom.operators.normalize import normalize_fields
from commitloom.sources.jsonl import read_jsonl, write_jsonl


def normalize_jsonl(
    spark: SparkSession, source: str | list[str], target: str, fields: Sequence[str] = fv.TEXT_FIELDS, **options
) -> None:
    """Normalise ``fields`` of every line of ``source`` where they hold text; all other members stay as they are."""
    schema = StructType([StructField(name, StringType()) for name in fields])
    lines = read_jsonl(spark, source, schema, whole_line="_line")
    write_jsonl(normalize_fields(lines, fields, **options).select(*fields, "_line"), target, whole_line="_line")
