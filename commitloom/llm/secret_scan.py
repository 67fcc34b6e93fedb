"""Secrets in versioned text, with a ledger of what has been scanned."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commitloom.llm.rows import digest, document_id, shown_id
from commitloom.session import settle


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern`` from left to right; those whose ``group`` is shorter than ``min_length`` do not count."""

    name: str
    version: int
    pattern: str
    group: int = 0
    min_length: int = 0

    @property
    def id(self) -> str:
        return f"{self.name}@{self.version}"


# The base patterns, then the rules of this module.
RULES = (
    SecretRule(
        "assign",
        1,
        r"((?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)",
        group=2,
        min_length=6,
    ),
    SecretRule("access", 1, "AKIA[A-Z0-9]+", min_length=20),
    SecretRule("hex", 1, "[0-9a-f]{24,}"),
    SecretRule("private_key", 1, "-----BEGIN[A-Z ]{0,40}PRIVATE KEY-----"),
    SecretRule("github", 1, "gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", 1, "xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE_KINDS = ("assign", "access", "hex")
FINDING = "struct<rule: string, start: int, end: int>"


# Digits of a blob's name that a folder of the ledger stands for: a run reads the folders it needs.
PREFIX = 1


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``, begun if there is none: ``blob``, the ``rules`` scanned, the ``findings``.

    It lies in folders by the first digits of the blob (``prefix``).
    """
    none = spark.range(0).select(
        F.lit("").alias("blob"),
        F.array().cast("array<string>").alias("rules"),
        F.array().cast(f"array<{FINDING}>").alias("findings"),
        F.lit("").alias("prefix"),
    )
    none.write.mode("ignore").parquet(path)
    return spark.read.schema(none.schema).parquet(path)


def _append(entries: DataFrame, path: str) -> None:
    prefixed = entries.withColumn("prefix", F.substring("blob", 1, PREFIX)).repartition("prefix")
    prefixed.write.mode("append").partitionBy("prefix").parquet(path)


def _of_blobs(ledger: DataFrame, blobs: DataFrame) -> DataFrame:
    """The entries of the blobs at hand; what else the ledger holds is not carried further."""
    return ledger.join(blobs, ["prefix", "blob"], "left_semi")


def _stretches(text: Column, rule: SecretRule) -> Column:
    """Each match's distance from the end of the one before, its length, and whether it counts.

    Splitting at the matches gives the gaps, extracting them the lengths: no
    position is looked for one by one.
    """
    pattern = F.lit(rule.pattern)
    pairs = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, 0).alias("whole"),
        F.regexp_extract_all(text, pattern, rule.group).alias("part"),
    )
    found = F.transform(
        pairs,
        lambda p, at: F.struct(
            F.lit(rule.id).alias("rule"),
            at.alias("at"),
            F.length(p["gap"]).alias("gap"),
            F.length(p["whole"]).alias("size"),
            (F.length(p["part"]) >= rule.min_length).alias("counts"),
        ),
    )
    return F.when(text.rlike(rule.pattern), F.filter(found, lambda p: p["size"].isNotNull()))


def _scanned(texts: DataFrame, rules: Sequence[SecretRule]) -> DataFrame:
    """Ledger rows of ``texts(blob, todo, text)``: each blob with the rules in ``todo`` and what they found."""
    none = F.array().cast("array<struct<rule: string, at: int, gap: int, size: int, counts: boolean>>")
    each = [
        F.coalesce(F.when(F.array_contains("todo", rule.id), _stretches(F.col("text"), rule)), none) for rule in rules
    ]
    raw = settle(texts.select("blob", "todo", F.concat(*each).alias("_found")), "scanned-blobs")
    so_far = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int")
    findings = (
        raw.select("blob", F.explode("_found").alias("f"))
        .select("blob", "f.*")
        .withColumn("end", end)
        .filter("counts")
        .groupBy("blob")
        .agg(F.collect_list(F.struct("rule", (F.col("end") - F.col("size")).alias("start"), "end")).alias("findings"))
    )
    empty = F.array().cast(f"array<{FINDING}>")
    return raw.join(findings, "blob", "left").select(
        "blob", F.col("todo").alias("rules"), F.coalesce("findings", empty).alias("findings")
    )


def scan_secrets(
    documents: DataFrame,
    ledger_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: Sequence[SecretRule] = RULES,
) -> DataFrame:
    """``_id``, ``blob`` and ``findings`` of every row; what was scanned for it is added to the ledger.

    Every version of a text is a blob, named by its SHA-256; null counts as
    empty.  Only pairs of blob and rule version that the ledger does not hold
    are scanned, each once: of the documents that share a blob, one brings its
    text.  Findings go to the ledger and from there to all documents with the
    blob, under the rule versions given.  A rule's new version is scanned for in
    old blobs too; what an old version found stays in the ledger and is not
    reported.  Of the ledger only entries of the blobs at hand are joined.

    Rows that repeat an id, or have none, are reported each by its own text; an
    empty table scans nothing.  A run that was broken off after writing is
    repeated without harm: entries that stand twice are one.
    """
    spark = documents.sparkSession
    current = F.array(*[F.lit(rule.id) for rule in rules])
    whole = F.coalesce(F.col(text), F.lit(""))
    blobs = settle(documents.select(document_id(doc_id).alias("_id"), digest(whole).alias("blob")), "blobs")
    distinct = settle(
        blobs.groupBy("blob", "_id")
        .agg(F.count("*").alias("_rows"))
        .groupBy("blob")
        .agg(F.min(F.struct("_id", "_rows")).alias("one"))
        .select("blob", "one.*", F.substring("blob", 1, PREFIX).alias("prefix")),
        "distinct-blobs",
    )
    names = distinct.select("prefix", "blob")
    known = (
        _of_blobs(open_ledger(spark, ledger_path), names)
        .select("blob", F.explode("rules").alias("rule"))
        .groupBy("blob")
        .agg(F.collect_set("rule").alias("rules"))
    )
    none = F.array().cast("array<string>")
    unseen = settle(
        distinct.join(known, "blob", "left")
        .withColumn("todo", F.array_except(current, F.coalesce("rules", none)))
        .filter(F.size("todo") > 0)
        .select("blob", "_id", "_rows", "todo"),
        "unseen-blobs",
    )
    texts = documents.select(document_id(doc_id).alias("_id"), digest(whole).alias("blob"), whole.alias("text"))
    once = texts.join(unseen.filter("_rows = 1"), ["_id", "blob"]).select("blob", "todo", "text")
    repeated = unseen.filter("_rows > 1")
    if not repeated.isEmpty():
        # Of rows equal in id and text one is taken, before the shuffle where it can be.
        firsts = texts.join(repeated, ["_id", "blob"]).groupBy("blob").agg(F.first("todo").alias("todo"), F.first("text").alias("text"))
        once = once.unionByName(firsts)
    _append(_scanned(once, rules), ledger_path)
    reported = settle(
        _of_blobs(open_ledger(spark, ledger_path), names)
        .select("blob", F.filter("findings", lambda f: F.array_contains(current, f["rule"])).alias("findings"))
        .filter(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings")),
        "findings",
    )
    empty = F.array().cast(f"array<{FINDING}>")
    return blobs.join(reported, "blob", "left").select("_id", "blob", F.coalesce("findings", empty).alias("findings"))


def first_part(doc_id: str = "doc_id") -> Column:
    """Half of the documents, by a checksum of the id: what a ledger may hold before the rest comes."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 2 == 0


def shown(found: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Counts of the base kinds and the spans as text, by start, then by the order of the rules."""
    names = F.array(*[F.lit(rule.name) for rule in rules])
    ids = F.array(*[F.lit(rule.id) for rule in rules])
    ordered = F.array_sort(
        F.transform(
            "findings",
            lambda f: F.struct(
                f["start"].alias("start"), F.array_position(ids, f["rule"]).alias("place"), f["end"].alias("end")
            ),
        )
    )
    spans = F.transform(
        "_spans",
        lambda s: F.struct(
            F.get(names, s["place"].cast("int") - 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    kinds = found.withColumn("_spans", ordered).withColumn("_spans", spans)

    def counted(kind: str) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("_spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return kinds.select(
        shown_id("_id").alias("doc_id"),
        *map(counted, BASE_KINDS),
        digest(listed(base)).alias("base_sha256"),
        listed(F.col("_spans")).alias("spans"),
    )
