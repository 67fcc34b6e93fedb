"""One query per operator.  Each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from commitloom import fixed_values as fv
from commitloom.functions import text as tx
from commitloom.functions.licence import license_field
from commitloom.operators import (
    catalog,
    diffs,
    history,
    language,
    normalize,
    repo_meta,
    samples,
    token_rows,
    walk,
)
from commitloom.plans.commit_records import commit_records
from commitloom.plans.normalize_jsonl import normalize_jsonl
from commitloom.plans.repo_list import repository_list
from commitloom.plans.training_rows import history_to_samples
from commitloom.session import fresh_path, tune
from commitloom.sources import jsonl, repo_list
from workload import views
from workload.views import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Sizes at which the small tables still show every branch; whole plans run at the library's own.
CAP = 5
MAX_DIFF = 90
MAX_STYLE = 400
ROW_LENGTH = 64
BOS, EOS, PAD = 1, 2, 0
# Lines of a packed file, which one task reads.
PACKED_LINES = 50_000


def query(run: Query) -> Query:
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(tune(spark), sf_dir)

    QUERIES[run.__name__] = tuned
    return run


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


# --- sources and sinks --------------------------------------------------------


@query
def jsonl_scan_skip(spark, sf_dir):
    """Every document as a good line, followed by a blank and three kinds of broken line."""
    line = F.to_json(F.struct("doc_id", "text", "lang"))
    endings = [" {}", ',"x":9', ',"row":{"doc_id":99}', ',"whole":1}', ']']
    ended = [F.concat(F.col("line"), F.lit(ending)) for ending in endings]
    broken = F.array(line, F.lit("  "), F.expr("left(line, length(line) - 1)"), *ended, F.lit("7"))
    path = fresh_path(spark, "scan") + "/lines.jsonl"
    lines = _documents(spark, sf_dir).select("doc_id", "text", "lang", line.alias("line"))
    # Packed, as a line and its broken kinds repeat each other; in parts, as packed files cannot be split.
    lines.select(F.explode(broken)).write.option("maxRecordsPerFile", PACKED_LINES).text(path, compression="snappy")
    schema = StructType(
        [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())]
    )
    return jsonl.read_jsonl(spark, path, schema)


@query
def jsonl_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "roundtrip")
    out = _documents(spark, sf_dir).withColumn("lang", F.nullif("lang", F.lit("fr")))
    jsonl.write_jsonl(out, path)
    return jsonl.read_jsonl(spark, path, out.schema, mode="fail")


@query
def jsonl_by_repo(spark, sf_dir):
    path = fresh_path(spark, "by-repo")
    out = views.commits(spark, sf_dir).select("repo", "commit_key", "author_name")
    jsonl.write_by_repo(out, path)
    schema = StructType([StructField("commit_key", LongType()), StructField("author_name", StringType())])
    return jsonl.read_jsonl(spark, path, schema, mode="fail")


@query
def jsonl_rejects(spark, sf_dir):
    """Nine lines a document, in files of 500 documents: what is left out, by its place in the file."""
    line = F.to_json(F.struct("doc_id", "text", "lang"))
    lines = F.array(
        line,
        F.lit(" \t"),
        F.concat(F.lit(" "), line),
        F.expr("left(line, length(line) - 1)"),
        F.concat("line", "line"),
        F.concat("line", F.lit(",")),
        F.lit("[1]"),
        F.lit("null"),
        F.concat("line", F.lit("]")),
    )
    documents = _documents(spark, sf_dir).withColumns({"line": line, "bucket": F.floor(F.col("doc_id") / 500)})
    path = fresh_path(spark, "rejects")
    placed = documents.repartition("bucket").sortWithinPartitions("bucket", "doc_id")
    # Packed, as a line and its broken kinds repeat each other.
    placed.select("bucket", F.explode(lines).alias("value")).write.partitionBy("bucket").text(path, compression="snappy")
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
    _, rejects = jsonl.read_jsonl_with_rejects(spark, path, schema)
    bucket = F.regexp_extract("file", "bucket=([0-9]+)", 1).cast("long").alias("bucket")
    return rejects.select(bucket, "line_no", "reason")


def _newest_first() -> list[Column]:
    return [F.col("committed_at").desc(), F.col("commit_key")]


_WRITTEN = StructType([StructField("commit_key", LongType()), StructField("author_name", StringType())])


@query
def jsonl_ordered(spark, sf_dir):
    """Lines of a repository as its parts give them, the newest commit first."""
    path = fresh_path(spark, "ordered")
    commits = views.commits(spark, sf_dir).select("repo", "commit_key", "committed_at", "author_name")
    jsonl.write_ordered_by_repo(commits, path, _newest_first(), part_rows=8)
    return jsonl.read_ordered(spark, path, _WRITTEN).drop("author_name")


@query
def jsonl_rerun(spark, sf_dir):
    """A second run over some owners replaces their repositories and no others."""
    path = fresh_path(spark, "rerun")
    commits = views.commits(spark, sf_dir).select("repo", "commit_key", "committed_at", "author_name")
    jsonl.write_ordered_by_repo(commits, path, _newest_first())
    again = commits.filter(F.substring("repo", 4, 1) < "4").withColumn("author_name", F.lit("rerun"))
    jsonl.write_ordered_by_repo(again, path, _newest_first(), part_rows=8, only_these=True)
    return jsonl.read_ordered(spark, path, _WRITTEN)


@query
def repo_list_scan(spark, sf_dir):
    """Names as padded lines, among comments, blanks and names without an owner."""
    name = F.col("full_name")
    lines = F.array(
        F.concat(F.lit("  "), name, F.lit(" \t")),
        F.concat(F.lit(" # "), name),
        F.lit(" "),
        F.substring_index(name, "/", -1),
    )
    path = fresh_path(spark, "list")
    views.repo_catalog(spark, sf_dir).select(F.explode(lines)).write.text(path)
    return repo_list.read_repo_list(spark, path)


@query
def repo_list_sink(spark, sf_dir):
    path = fresh_path(spark, "list")
    repo_list.write_repo_list(catalog.distinct_sorted(views.repo_catalog(spark, sf_dir), "full_name"), path)
    return spark.read.text(path).select(F.col("value").alias("full_name"))


# --- catalogue ------------------------------------------------------------------


@query
def catalog_filter(spark, sf_dir):
    return catalog.filter_catalog(views.repo_catalog(spark, sf_dir), min_stars=1000, exclude_archived=True)


@query
def top_repos(spark, sf_dir):
    top = catalog.top_repos(views.repo_catalog(spark, sf_dir), "en, fr ,, de", max_pages=1, min_stars=100)
    return top.select("full_name", "language", "stars", "archived", "position")


@query
def distinct_repos(spark, sf_dir):
    return catalog.distinct_sorted(views.repo_catalog(spark, sf_dir), "full_name")


@query
def exclude_substring(spark, sf_dir):
    """Exclusions: names of the largest repositories, shortened by one, so they match others as well."""
    repos = views.repo_catalog(spark, sf_dir)
    big = repos.filter(F.col("stars") > 6000).select(F.expr("left(full_name, length(full_name) - 1)").alias("s"))
    return catalog.exclude_by_substring(repos.select("full_name", "stars"), "full_name", big)


@query
def exclude_exact(spark, sf_dir):
    repos = views.repo_catalog(spark, sf_dir)
    big = repos.filter(F.col("stars") > 6000).select(F.col("full_name").alias("s"))
    return catalog.exclude_by_substring(repos.select("full_name", "stars"), "full_name", big, exact=True)


@query
def repo_list_plan(spark, sf_dir):
    """The list as it is fetched: ranked, each name once, without the largest names and their likes, sorted."""
    repos = views.repo_catalog(spark, sf_dir)
    big = repos.filter(F.col("stars") > 6000).select(F.expr("left(full_name, length(full_name) - 1)").alias("s"))
    return repository_list(repos, big, "en,fr,de", max_pages=1, min_stars=100)


@query
def integrity_split(spark, sf_dir):
    judged = catalog.judge_integrity(
        views.repositories(spark, sf_dir), views.commits_with_parents(spark, sf_dir)
    )
    return judged.withColumn("reason", F.coalesce("reason", F.lit("ok")))


def _branching(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    commits = views.branching_commits(spark, sf_dir)
    return commits, views.refs(commits)


@query
def reachable_integrity(spark, sf_dir):
    judged = walk.judge_reachable(views.repositories(spark, sf_dir), *_branching(spark, sf_dir))
    return judged.withColumn("reason", F.coalesce("reason", F.lit("ok")))


# --- commits ----------------------------------------------------------------------


@query
def reachable_commits(spark, sf_dir):
    return walk.reachable_commits(*_branching(spark, sf_dir))


@query
def walk_order(spark, sf_dir):
    """Commits as a walk from HEAD meets them, where a sixth of all clocks is fast."""
    return walk.walk_order(*_branching(spark, sf_dir))


@query
def drop_merges(spark, sf_dir):
    return history.drop_merges(views.commits(spark, sf_dir)).select("commit_key", "n_parents")


@query
def newest_per_repo(spark, sf_dir):
    commits = views.commits(spark, sf_dir).select("repo", "commit_key", "committed_at")
    return history.newest_per_repo(commits, CAP, tie="commit_key").drop("committed_at")


def _with_history(spark, sf_dir, cap: int) -> DataFrame:
    # Bodies end here: of a message, history shows the first line only.
    columns = ["repo", "commit_key", "commit_id", "committed_at", tx.first_line(F.col("message")).alias("message")]
    commits = history.drop_merges(views.commits(spark, sf_dir)).select(*columns)
    return history.with_recent_history(commits, cap, tie="commit_key").drop("message", "committed_at")


@query
def recent_history(spark, sf_dir):
    return _with_history(spark, sf_dir, CAP)


@query
def recent_history_uncapped(spark, sf_dir):
    """No bound on a repository: the numbering that never gathers one in a task."""
    return _with_history(spark, sf_dir, fv.MAX_COMMITS_CEILING)


@query
def drop_noise(spark, sf_dir):
    return history.drop_noise_subjects(views.commits(spark, sf_dir)).select("commit_key", "message")


@query
def drop_bots(spark, sf_dir):
    return history.drop_bot_authors(views.commits(spark, sf_dir)).select("commit_key", "author_name")


@query
def clean_message(spark, sf_dir):
    message = tx.clean_message(F.col("message")).alias("commit_msg")
    return views.commits(spark, sf_dir).select("commit_key", message)


@query
def py_strip(spark, sf_dir):
    padded = F.concat(F.lit(" \t　 "), "text", F.lit("\x1f \n\x85"))
    return _documents(spark, sf_dir).select("doc_id", tx.py_strip(padded).alias("stripped"))


# --- diffs --------------------------------------------------------------------------


@query
def assemble_diff(spark, sf_dir):
    found = diffs.assemble_diffs(views.patches(spark, sf_dir), ["commit_key"], MAX_DIFF)
    return found.select("commit_key", "change")


@query
def affected_files(spark, sf_dir):
    found = diffs.assemble_diffs(views.patches(spark, sf_dir), ["commit_key"], MAX_DIFF)
    return found.select("commit_key", F.array_join("affected_files", "|").alias("affected_files"))


@query
def diff_of_kept_commits(spark, sf_dir):
    """Diffs of chosen commits only; those without a patch get an empty one."""
    kept = history.drop_merges(views.commits(spark, sf_dir))
    kept = kept.select("commit_key")
    found = diffs.assemble_diffs(views.patches(spark, sf_dir), ["commit_key"], commits=kept)
    return diffs.with_diffs(kept, found, ["commit_key"]).withColumn("affected_files", F.array_join("affected_files", "|"))


@query
def truncate_marked(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", tx.truncate_marked(F.col("text"), MAX_STYLE).alias("cut"))


# --- repository facts and records ------------------------------------------------------


@query
def code_style(spark, sf_dir):
    return repo_meta.pick_code_style(views.repo_files(spark, sf_dir), MAX_STYLE)


@query
def license_of_repo(spark, sf_dir):
    return views.license_json(spark, sf_dir).select("repo", license_field(F.col("json")).alias("license"))


@query
def repo_source(spark, sf_dir):
    return repo_meta.with_repo_source(views.repositories(spark, sf_dir), views.remotes(spark, sf_dir))


@query
def repo_enrichment(spark, sf_dir):
    commits = views.commits(spark, sf_dir).select("repo", "commit_key")
    return repo_meta.with_repo_meta(
        commits, views.repo_files(spark, sf_dir), views.license_json(spark, sf_dir)
    )


def _records(spark, sf_dir, skip_bots: bool = False) -> DataFrame:
    return commit_records(
        views.commits(spark, sf_dir),
        views.patches(spark, sf_dir),
        views.repo_files(spark, sf_dir),
        views.license_json(spark, sf_dir),
        views.remotes(spark, sf_dir),
        key=["commit_key"],
        skip_bots=skip_bots,
        tie="commit_key",
    )


@query
def commit_record(spark, sf_dir):
    return _records(spark, sf_dir, True).withColumn("affected_files", F.array_join("affected_files", "|"))


@query
def count_by_repo(spark, sf_dir):
    return samples.count_by_repo(history.drop_noise_subjects(history.drop_merges(views.commits(spark, sf_dir))))


# --- text normalisation ------------------------------------------------------------------


def _decomposed(spark, sf_dir, *others: str) -> DataFrame:
    """Documents with accents split off, CRLF line ends, doubled spaces and odd characters."""
    text = F.col("text")
    for whole, parts in (("é", "é"), ("è", "è"), ("ü", "ü")):
        text = F.replace(text, F.lit(whole), F.lit(parts))
    for plain, odd in (("\n", "\r\n"), (" ", "  "), ("q", "​αд"), ("W", "\U0001f600")):
        text = F.replace(text, F.lit(plain), F.lit(odd))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), *others)


def _text_query(spark, sf_dir, change: Callable[[Column], Column]) -> DataFrame:
    return _decomposed(spark, sf_dir).select("doc_id", change(F.col("text")).alias("text"))


@query
def norm_nfc(spark, sf_dir):
    return _text_query(spark, sf_dir, tx.unicode_normalize)


@query
def norm_nfkc_halfwidth(spark, sf_dir):
    wide = F.translate("text", "ABCDEabcde()", "ＡＢＣＤＥａｂｃｄｅ（）")
    documents = _documents(spark, sf_dir)
    return documents.select("doc_id", tx.to_halfwidth(wide).alias("text"))


@query
def strip_unlisted(spark, sf_dir):
    return _text_query(spark, sf_dir, tx.strip_unlisted_chars)


@query
def unify_newlines(spark, sf_dir):
    return _text_query(spark, sf_dir, tx.unify_newlines)


@query
def squeeze_spaces(spark, sf_dir):
    return _text_query(spark, sf_dir, tx.squeeze_spaces)


@query
def normalize_fields(spark, sf_dir):
    """The chain on two of three columns."""
    wide = _decomposed(spark, sf_dir).select(
        "doc_id", F.col("text").alias("change"), F.lit(" \t ").alias("commit_msg"), F.col("text").alias("other")
    )
    return normalize.normalize_fields(wide)


@query
def jsonl_normalize(spark, sf_dir):
    """The stage from file to file; members it does not name, and a number in one it names, come through."""
    lines = _decomposed(spark, sf_dir, "lang", "source", "n_chars").select(
        "doc_id",
        F.col("text").alias("commit_msg"),
        F.col("n_chars").alias("change"),
        F.struct("lang", F.array("source", "text").alias("deep")).alias("other"),
    )
    source, target = fresh_path(spark, "lines"), fresh_path(spark, "normal-lines")
    jsonl.write_jsonl(lines, source)
    normalize_jsonl(spark, source, target, ["commit_msg", "change"])
    found = jsonl.read_jsonl(spark, target, lines.schema, mode="fail")
    return found.select("doc_id", "commit_msg", "change", "other.lang", F.array_join("other.deep", "|").alias("deep"))


# --- language --------------------------------------------------------------------------------


@query
def min_length(spark, sf_dir):
    """Whole documents, but three sources are blank, too short and just long enough."""
    source = F.col("source")
    shaped = F.when(source == "src1", " \n").when(source == "src2", " \nab  ").when(source == "src3", " abc\t")
    documents = table(spark, sf_dir, "documents")
    return samples.min_length(documents.select("doc_id", shaped.otherwise(F.col("text")).alias("text")), "text")


@query
def language_profile(spark, sf_dir):
    return language.language_profile(_documents(spark, sf_dir))


def _even_profile(documents: DataFrame) -> DataFrame:
    return language.language_profile(documents.filter(F.col("doc_id") % 2 == 0))


@query
def detect_language(spark, sf_dir):
    """All documents, by a profile of the even ones: the others were never seen."""
    documents = _documents(spark, sf_dir)
    return language.detect_language(documents, _even_profile(documents), ["doc_id"])


@query
def detect_language_shuffled(spark, sf_dir):
    """The same with a profile taken to be too large to broadcast."""
    documents = _documents(spark, sf_dir)
    return language.detect_language(documents, _even_profile(documents), ["doc_id"], broadcast_bytes=0)


@query
def filter_language(spark, sf_dir):
    """Conversation turns in English or German, by the documents' profile."""
    turns = table(spark, sf_dir, "conversations").withColumnRenamed("text", "target")
    profile = language.language_profile(_documents(spark, sf_dir))
    return language.filter_language(turns, profile, ["conv_id", "turn"], langs=("en", "de"))


# --- samples -------------------------------------------------------------------------------------


def _record_shapes(spark, sf_dir) -> DataFrame:
    """Documents as records, with missing, empty and blank members by language and source."""
    lang, source = F.col("lang"), F.col("source")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(source == "src4", " x ").otherwise(F.col("text")).alias("commit_msg"),
        F.when(lang == "fr", None).when(lang == "de", "").otherwise(F.concat(F.lit(" "), "text")).alias("change"),
        F.when(source == "src5", None).when(source == "src6", " ").otherwise(source).alias("recent_commits_message"),
        F.when(lang == "es", None).when(source == "src7", " \n").otherwise(F.concat("lang", F.lit("\n"))).alias("code_style"),
        F.when(source == "src8", None).when(lang == "en", F.array("source", "lang")).otherwise(F.array()).alias("affected_files"),
    )


@query
def prompt_defaults(spark, sf_dir):
    return samples.prompt_defaults(_record_shapes(spark, sf_dir))


@query
def format_prompt(spark, sf_dir):
    return samples.format_prompt(_record_shapes(spark, sf_dir))


@query
def format_prompt_bare(spark, sf_dir):
    return samples.format_prompt(_record_shapes(spark, sf_dir), instruction=None, min_length=0)


@query
def run_counters(spark, sf_dir):
    written = tx.long_enough(F.col("commit_msg"))
    counted, seen = samples.with_counters(_record_shapes(spark, sf_dir), "run", written=written)
    counted.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["parsed"], seen.get["written"])], "parsed long, written long")


# --- token rows --------------------------------------------------------------------------------------


def _pairs(spark, sf_dir) -> DataFrame:
    """Pages as pairs, each with its whole text: in a long target, or in a prompt before a short one."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.startswith("url", F.lit("https://m.")), F.repeat(url, F.lit(3)))
        .when(F.startswith("url", F.lit("http:")), url)
        .otherwise(F.concat("html", url))
        .alias("prompt"),
        F.when(F.startswith("url", F.lit("http:")), F.concat("html", url))
        .when(F.startswith("url", F.lit("https://m.")), F.col("html"))
        .otherwise(F.substring_index("url", "/", -1))
        .alias("target"),
    )


def _joined(df: DataFrame, *columns: str) -> DataFrame:
    texts = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in columns]
    return df.select("page_id", *texts)


@query
def token_ids(spark, sf_dir):
    """Code point ids of whole pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("prompt"), F.col("url").alias("target"))
    return _joined(token_rows.with_token_ids(pages), "prompt_ids", "target_ids")


@query
def append_eos(spark, sf_dir):
    return _joined(token_rows.with_token_ids(_pairs(spark, sf_dir), eos=EOS), "target_ids")


@query
def fit_to_length(spark, sf_dir):
    ids = token_rows.with_token_ids(_pairs(spark, sf_dir), eos=EOS)
    return _joined(token_rows.fit_to_length(ids, ROW_LENGTH, BOS), "prompt_ids", "target_ids")


def _token_rows(spark, sf_dir) -> DataFrame:
    ids = token_rows.with_token_ids(_pairs(spark, sf_dir), eos=EOS)
    fitted = token_rows.fit_to_length(ids, ROW_LENGTH, BOS)
    return token_rows.pad_and_label(fitted, ROW_LENGTH, BOS, PAD)


@query
def pad_and_mask(spark, sf_dir):
    return _joined(_token_rows(spark, sf_dir), "input_ids", "attention_mask")


@query
def labels(spark, sf_dir):
    return _joined(_token_rows(spark, sf_dir), "labels")


# --- composites ------------------------------------------------------------------------------------------


@query
def commit_history_samples(spark, sf_dir):
    """The smallest whole query: history and message of each kept commit, as a sample."""
    # Bodies end here: they would travel with the ranking.
    columns = ["repo", "commit_key", "commit_id", "committed_at", tx.message_head(F.col("message")).alias("message")]
    commits = history.drop_merges(views.commits(spark, sf_dir)).select(*columns)
    kept = history.drop_noise_subjects(history.with_recent_history(commits, tie="commit_key"))
    return kept.select(
        "commit_key",
        F.concat(F.lit(fv.LABEL_RECENT), "recent_commits_message", F.lit("\n" + fv.LABEL_MESSAGE)).alias("prompt"),
        tx.clean_message(F.col("message")).alias("target"),
    )


def _samples(spark, sf_dir) -> DataFrame:
    return history_to_samples(
        views.commits(spark, sf_dir),
        views.patches(spark, sf_dir),
        views.repo_files(spark, sf_dir),
        profile=language.language_profile(_documents(spark, sf_dir)),
        langs=("en",),
        key=["commit_key"],
        skip_bots=True,
        tie="commit_key",
    )


@query
def history_to_training_samples(spark, sf_dir):
    return _samples(spark, sf_dir).select("commit_key", "prompt", "target")


@query
def history_to_token_rows(spark, sf_dir):
    """Samples of all kept commits as rows of full length, digested to stay comparable."""
    ids = token_rows.with_token_ids(_samples(spark, sf_dir), eos=EOS)
    rows = token_rows.pad_and_label(token_rows.fit_to_length(ids, fv.MAX_TOKENS, BOS), fv.MAX_TOKENS, BOS, PAD)
    digest = [
        F.md5(F.array_join(F.col(c).cast("array<string>"), ",")).alias(c)
        for c in ("input_ids", "attention_mask", "labels")
    ]
    return rows.select("commit_key", *digest)
