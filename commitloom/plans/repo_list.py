"""From a repository catalogue to the list of repositories to fetch."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from commitloom import fixed_values as fv
from commitloom.operators.catalog import distinct_sorted, exclude_by_substring, top_repos


def repository_list(
    catalog: DataFrame,
    exclusions: DataFrame | None,
    langs: str | Iterable[str],
    max_pages: int,
    min_stars: int = fv.MIN_STARS,
    exclude_archived: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Names of the most starred repositories of each language, each once, sorted, without excluded ones."""
    names = top_repos(catalog, langs, max_pages, min_stars, exclude_archived).select("full_name").distinct()
    if exclusions is not None:
        names = exclude_by_substring(names, "full_name", exclusions, exact)
    return distinct_sorted(names, "full_name")
