"""Repository lists: one ``owner/name`` per text line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitloom.functions.text import py_strip


def read_repo_list(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed lines holding a slash; blank and ``#`` lines are skipped."""
    name = py_strip(F.col("value"))
    return (
        spark.read.text(path)
        .select(name.alias("full_name"))
        .filter(~F.startswith("full_name", F.lit("#")) & F.contains("full_name", F.lit("/")))
    )


def write_repo_list(df: DataFrame, path: str, name: str = "full_name", mode: str = "errorifexists") -> None:
    df.select(name).write.mode(mode).text(path)
