"""Repository catalogue: filter, rank, deduplicate, exclude, check."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitloom import fixed_values as fv
from commitloom.operators.ranking import first_rows
from commitloom.session import settle

# Code points of a gram that names are indexed by.
GRAM_SIZE = 3


def filter_catalog(
    catalog: DataFrame, min_stars: int = fv.MIN_STARS, exclude_archived: bool = False
) -> DataFrame:
    """Repositories with more than ``min_stars`` stars, optionally without archived ones."""
    kept = catalog.filter(F.col("stars") > min_stars)
    return kept.filter(~F.col("archived")) if exclude_archived else kept


def top_repos(
    catalog: DataFrame,
    langs: str | Iterable[str],
    max_pages: int,
    min_stars: int = fv.MIN_STARS,
    exclude_archived: bool = False,
) -> DataFrame:
    """The most starred ``max_pages`` pages of repositories of each wanted language."""
    names = langs.split(",") if isinstance(langs, str) else langs
    wanted = sorted({name.strip() for name in names} - {""})
    kept = filter_catalog(catalog, min_stars, exclude_archived).filter(F.col("language").isin(wanted))
    order = [F.col("stars").desc(), F.col("full_name"), F.col("archived")]
    return first_rows(kept, ["language"], order, max_pages * fv.REPOS_PER_PAGE, ["full_name", "stars"])


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def _grams(text: Column, size: int) -> Column:
    """The different stretches of ``size`` code points, or none."""
    begins = F.sequence(F.lit(1), F.length(text) - (size - 1))
    found = F.array_distinct(F.transform(begins, lambda at: F.substring(text, at, F.lit(size))))
    return F.when(F.length(text) >= size, found).otherwise(F.array().cast("array<string>"))


def exclude_by_substring(
    df: DataFrame, column: str, exclusions: DataFrame, exact: bool = False, gram_size: int = GRAM_SIZE
) -> DataFrame:
    """Rows whose ``column`` contains none of the strings in ``exclusions.s``.

    Names are indexed by their grams, stretches of ``gram_size`` code points,
    of which a name has no more than code points.  Each string is looked for
    by the one of its grams that the fewest names have, its seed; a name that
    has the seed is then searched for the string.  Strings shorter than a gram
    are grams themselves; a string one of whose grams no name has is in none.
    No name is compared with every string, and the seeds meet the grams in an
    equality join that Spark can hash, broadcast or split by size.  What
    matched is settled before it meets the rows, so that a name with many
    copies can be split.

    A null name contains nothing and a null string is in no name; the empty
    string is in every name that is not null.
    """
    strings = exclusions.select(F.col("s").alias("_excluded")).filter(F.col("_excluded").isNotNull()).distinct()
    if exact:
        return df.join(settle(strings.withColumnRenamed("_excluded", column), "excluded"), column, "left_anti")
    strings = settle(strings, "exclusions")
    name, string = F.col(column), F.col("_excluded")
    sizes = [row["n"] for row in strings.select(F.least(F.length(string), F.lit(gram_size)).alias("n")).distinct().collect()]
    names = df.select(column).filter(name.isNotNull()).distinct()
    if 0 in sizes:
        matched = names
    elif not sizes:
        return df
    else:
        each = F.flatten(F.array(*[_grams(name, size) for size in sizes]))
        index = settle(names.select(column, F.explode(each).alias("_gram")), "name-grams")
        frequency = index.groupBy("_gram").agg(F.count("*").alias("_names"))
        own = F.coalesce(*[F.when(F.least(F.length(string), F.lit(gram_size)) == size, _grams(string, size)) for size in sizes])
        rarest = F.min(F.struct(F.coalesce("_names", F.lit(0)).alias("names"), F.col("_gram").alias("gram"))).alias("_seed")
        seeds = strings.select("_excluded", F.explode(own).alias("_gram")).join(frequency, "_gram", "left")
        seeds = seeds.groupBy("_excluded").agg(rarest).filter("_seed.names > 0").select("_excluded", F.col("_seed.gram").alias("_gram"))
        matched = index.join(settle(seeds, "seeds"), "_gram").filter(F.contains(name, string)).select(column).distinct()
    return df.join(settle(matched, "excluded"), column, "left_anti")


def judge_integrity(repos: DataFrame, commits: DataFrame) -> DataFrame:
    """``repos`` with the ``reason`` for which a repository fails, null where it passes.

    A repository fails without any commit, or when a parent named by one of
    its commits is not among them.  Commits are read once: each gives its own
    id and those of its parents, which meet by (repo, id), so a large
    repository is many keys.
    """
    own = F.array(F.struct(F.col("commit_id").alias("id"), F.lit(True).alias("known")))
    parents = F.coalesce("parents", F.array().cast("array<string>"))
    named = F.transform(parents, lambda p: F.struct(p.alias("id"), F.lit(False).alias("known")))
    complete = (
        commits.select("repo", F.inline(F.concat(own, named)))
        .groupBy("repo", "id")
        .agg(F.bool_or("known").alias("known"))
        .groupBy("repo")
        .agg(F.bool_and("known").alias("_complete"))
    )
    reason = F.when(F.col("_complete").isNull(), "no commits").when(~F.col("_complete"), "missing parent")
    return repos.join(complete, "repo", "left").select(*repos.columns, reason.alias("reason"))


def split_by_integrity(repos: DataFrame, commits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repositories that pass, and those that fail with the ``reason``.  Nothing is deleted."""
    judged = judge_integrity(repos, commits)
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(F.col("reason").isNotNull())
