"""From raw documents to shards of a mixed corpus, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commitloom.llm import decontaminate, language_id, mixing, sharding, simhash
from commitloom.llm.shipping import ship
from commitloom.session import fresh_path, tune


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word that tells their language.

    The model is learned from the labelled documents that came in; without
    labels all documents stay.  Texts that are null, empty or without a letter
    go; repeated rows stay repeated; an empty table stays empty.
    """
    ship(tune(spark))
    return language_id.keep_determined(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest ``doc_id``.

    Documents without an id, or with one that others repeat, are told apart by
    their texts; rows equal in both count once.  Null and empty texts are copies
    of each other; an empty table stays empty.
    """
    ship(tune(spark))
    return simhash.drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are in benchmark windows.

    Null and empty texts have no words and stay, as do repeated rows, each
    judged by its own text; an empty table, or an empty benchmark, changes nothing.
    """
    ship(tune(spark))
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, which may be not at all.

    A null source is a source; null and empty texts have no words; rows equal in
    id and text share their copies; an empty table stays empty.
    """
    ship(tune(spark))
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ``shard``, ``slot`` and ``size``; shards have nearly equal bytes.

    Null and empty texts count one byte; equal texts, repeated rows and rows
    without an id are placed each by itself; an empty table gives no row.
    """
    ship(tune(spark))
    return sharding.shard(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mixture", mixture),
    ("shards", shards),
]
# Learned models and components over fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = fresh_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
