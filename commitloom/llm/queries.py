"""One query per operator over the whole documents table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitloom.llm import (
    collocations,
    decontaminate,
    language_id,
    license_scan,
    line_crf,
    line_dedup,
    mixing,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    substring_dedup,
    vector_codes,
)
from commitloom.llm.rows import digest
from commitloom.llm.shipping import ship
from commitloom.session import fresh_path, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(ship(tune(spark)), sf_dir)

    QUERIES[run.__name__] = tuned
    return run


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark, sf_dir):
    """Learns from the documents that are not held out, and labels all."""
    documents = _table(spark, sf_dir)
    held_out = language_id.held_out()
    model = language_id.train(documents.filter(~held_out))
    found = language_id.detect(documents, model)
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


@query
def op2_quality_rules(spark, sf_dir):
    judged, _ = quality_rules.judge(_table(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
        "rule_text",
    )


@query
def op3_simhash_dedup(spark, sf_dir):
    return simhash.shown(simhash.near_duplicates(_table(spark, sf_dir)))


@query
def op4_source_mix(spark, sf_dir):
    return mixing.shown(mixing.mix(_table(spark, sf_dir)))


@query
def op5_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_shared_lines(_table(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", digest(F.col("text")).alias("kept_sha256"))


@query
def op6_substring_dedup(spark, sf_dir):
    return substring_dedup.shown(substring_dedup.drop_repeated_windows(_table(spark, sf_dir)))


@query
def op7_histogram_shards(spark, sf_dir):
    return sharding.placements(_table(spark, sf_dir))


@query
def op8_license_scan(spark, sf_dir):
    return license_scan.shown(license_scan.scan_licenses(_table(spark, sf_dir)))


@query
def op9_secret_ledger(spark, sf_dir):
    """Two scans with one ledger: a first half of the documents, then all of them, of which only the rest is scanned."""
    documents, ledger = _table(spark, sf_dir), fresh_path(spark, "secret-ledger")
    secret_scan.scan_secrets(documents.filter(secret_scan.first_part()), ledger)
    return secret_scan.shown(secret_scan.scan_secrets(documents, ledger))


@query
def op10_decontaminate(spark, sf_dir):
    found = decontaminate.find_contamination(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest(F.array_join(F.array_sort("items"), ",")).alias("items_sha256"),
        "contaminated",
    )


@query
def op11_line_crf(spark, sf_dir):
    """Learns from labelled documents that are not held out, and scores all."""
    documents, held_out = _table(spark, sf_dir), line_crf.held_out()
    examples = line_crf.training_documents(documents.filter(~held_out), _table(spark, sf_dir, "labels"))
    scored = line_crf.score_documents(documents, line_crf.train(examples))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("lines").alias("n_lines"))


@query
def op12_vector_codes(spark, sf_dir):
    return vector_codes.shown(*vector_codes.compress(_table(spark, sf_dir, "embeddings")))


@query
def op13_phrase_collocations(spark, sf_dir):
    found = collocations.collocations(_table(spark, sf_dir))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
