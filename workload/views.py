"""The history tables, derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commitloom.operators.ranking import number_in_group
from commitloom.session import settle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _repo(owner: Column) -> Column:
    return F.concat(F.lit("own"), (owner % 7).cast("string"), F.lit("/repo"), owner.cast("string"))


def _at_turn(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Give each row the one of ``others``, by its first column, that its key falls on when counted round."""
    at = F.col(key) % others.agg(F.count("*")).scalar()
    return df.withColumn("_at", at).join(others, F.col("_at") == F.col(others.columns[0])).drop("_at")


def _with_document(df: DataFrame, spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Give each row the document its key falls on."""
    return _at_turn(df, table(spark, sf_dir, "documents").select("doc_id", "text"), key)


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    subject = F.element_at(
        F.create_map(*map(F.lit, (0, "Merge ", 1, "Revert ", 2, "fixup! ", 3, "Fixes #12 "))),
        (F.col("o_orderkey") % 10).cast("int"),
    )
    return _with_document(orders, spark, sf_dir, "o_orderkey").select(
        F.col("o_orderkey").alias("commit_key"),
        F.sha1(F.col("o_orderkey").cast("string")).alias("commit_id"),
        _repo(F.col("o_custkey")).alias("repo"),
        F.col("o_orderdate").alias("committed_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 2).otherwise(1).alias("n_parents"),
        F.when(F.col("o_orderstatus") == "P", "deploy[bot]")
        .otherwise(F.concat(F.lit("dev"), (F.col("o_custkey") % 97).cast("string")))
        .alias("author_name"),
        F.concat(F.coalesce(subject, F.lit("")), "text").alias("message"),
    )


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    in_order = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )

    def path(variants: int) -> Column:
        number = (F.col("p_partkey") % variants).cast("string")
        return F.concat(F.lit("src/"), "p_brand", F.lit("/"), number, F.lit(".py"))

    return lineitem.join(part, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("l_orderkey").alias("commit_key"),
        F.row_number().over(in_order).alias("patch_idx"),
        path(7).alias("new_path"),
        path(5).alias("old_path"),
        F.concat(
            F.lit("diff "),
            F.col("l_partkey").cast("string"),
            F.lit(" "),
            "l_returnflag",
            F.lit("|"),
            F.expr("repeat('+', cast(l_quantity as int))"),
        ).alias("patch_text"),
    )


def repo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files per repository, so that the pick has something to choose from; one segment has none."""
    customer = (
        table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "FURNITURE").select("c_custkey")
    )
    variant = F.col("c_custkey") % 4
    main = (
        F.when(variant == 0, "STYLEGUIDE.md").when(variant == 1, "CONTRIBUTING.md").otherwise(
            ".github/CONTRIBUTING.md"
        )
    )
    second = F.when(variant == 2, "CONTRIBUTING.md").when(variant == 3, "STYLEGUIDE.md").otherwise("README.md")
    files = F.array(
        F.struct(main.alias("path"), F.col("text").alias("content")),
        F.struct(second.alias("path"), F.concat(F.lit("second\r\n"), "text").alias("content")),
    )
    return (
        _with_document(customer, spark, sf_dir, "c_custkey")
        .select(_repo(F.col("c_custkey")).alias("repo"), F.explode(files).alias("file"))
        .select("repo", "file.*")
    )


def repo_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repository of every document, named by the page it falls on."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    pages = table(spark, sf_dir, "pages").select("page_id")
    name = F.concat(
        F.lit("own"), (F.col("page_id") % 23).cast("string"), F.lit("/"), "lang", F.lit("-"), "source"
    )
    return (
        _at_turn(documents, pages, "doc_id")
        .select(
            name.alias("full_name"),
            F.col("lang").alias("language"),
            F.col("n_chars").alias("stars"),
            (F.col("doc_id") % 5 == 0).alias("archived"),
        )
        .distinct()
    )


def commits_with_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent: the previous commit of the repository, but an unknown one for dear orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    ids = orders.select(
        _repo(F.col("o_custkey")).alias("repo"),
        F.sha1(F.col("o_orderkey").cast("string")).alias("commit_id"),
        "o_orderdate",
        "o_orderkey",
        "o_totalprice",
    )
    # A repository may be huge, so its commits are numbered in chunks instead of by one window.
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    numbered = settle(number_in_group(ids, ["repo"], order), "numbered-commits")
    previous = numbered.select("repo", (F.col("position") + 1).alias("position"), F.col("commit_id").alias("previous"))
    parent = F.when(F.col("o_totalprice") > 480000, F.concat(F.lit("gone-"), "commit_id")).otherwise(F.col("previous"))
    return numbered.join(previous, ["repo", "position"], "left").select(
        "repo", "commit_id", F.array_compact(F.array(parent)).alias("parents")
    )


def branching_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits in lines of their repositories; each fourth also merges the one three before, each sixth has a fast clock.

    Parents of dear orders are unknown.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    clock = F.col("o_orderdate") + F.when(F.col("o_orderkey") % 6 == 0, F.expr("interval 400 days")).otherwise(
        F.expr("interval 0 days")
    )
    # Keys stand for names and ids until the commits are read.
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    numbered = settle(number_in_group(orders, ["o_custkey"], order), "numbered-commits")

    def before(n: int, name: str) -> DataFrame:
        return numbered.select("o_custkey", (F.col("position") + n).alias("position"), F.col("o_orderkey").alias(name))

    placed = settle(
        numbered.join(before(1, "previous"), ["o_custkey", "position"], "left").join(
            before(3, "earlier").filter(F.col("position") % 4 == 0), ["o_custkey", "position"], "left"
        ),
        "branching",
    )

    def id_of(key: str) -> Column:
        return F.sha1(F.col(key).cast("string"))

    first = F.when(F.col("o_totalprice") > 480000, F.concat(F.lit("gone-"), id_of("o_orderkey"))).otherwise(id_of("previous"))
    return placed.select(
        _repo(F.col("o_custkey")).alias("repo"),
        id_of("o_orderkey").alias("commit_id"),
        clock.alias("committed_at"),
        F.array_compact(F.array(first, id_of("earlier"))).alias("parents"),
        "position",
    )


def refs(branching: DataFrame) -> DataFrame:
    """Each repository's HEAD: its last commit but for those whose number ends in 1 (none) or 2 (the second commit)."""
    ending = F.substring("repo", -1, 1)
    newest = branching.groupBy("repo").agg(F.max("position").alias("position"))
    chosen = newest.filter(ending != "1").withColumn("position", F.when(ending == "2", F.least(F.lit(2), "position")).otherwise(F.col("position")))
    return chosen.join(branching.select("repo", "position", "commit_id"), ["repo", "position"]).select("repo", "commit_id")


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(_repo(F.col("c_custkey")).alias("repo"))


def license_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detector answers of every shape, by the kind of document a repository falls on."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lang, source = F.col("lang"), F.col("source")
    answer = (
        F.when(source == "src1", '{"licenses":[]}')
        .when(source == "src2", "not json")
        .when(source == "src3", '{"licenses":[{"key":"mit"}]} trailing')
        .when(lang == "en", F.concat(F.lit('{"licenses":[{"spdx_id":"'), source, F.lit('","key":"k"}]}')))
        .when(lang == "fr", F.concat(F.lit('{"licenses":[{"spdx_id":"","key":"'), source, F.lit('"}]}')))
        .when(lang == "de", F.concat(F.lit('{"licenses":[{"spdx_id":null,"key":"'), source, F.lit('"}]}')))
        .otherwise('{"licenses":[{"spdx_id":null}],"matched_files":[1,2]}')
    )
    return _at_turn(customer, documents, "c_custkey").select(
        _repo(F.col("c_custkey")).alias("repo"), answer.alias("json")
    )


def remotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two remotes per repository, the first without a url for repositories on http pages."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    first = F.when(F.startswith("url", F.lit("https:")), F.col("url")).otherwise("")
    both = F.array(
        F.struct(F.lit(1).alias("pos"), F.concat("url", F.lit("/mirror")).alias("url")),
        F.struct(F.lit(0).alias("pos"), first.alias("url")),
    )
    return (
        _at_turn(customer, pages, "c_custkey")
        .select(_repo(F.col("c_custkey")).alias("repo"), F.explode(both).alias("remote"))
        .select("repo", "remote.*")
    )
