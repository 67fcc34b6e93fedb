"""Catalogue operators."""

import random

import pytest

from commitloom.operators import catalog


def names(df, column="full_name"):
    return sorted(r[column] for r in df.collect())


CATALOG = "full_name string, language string, stars long, archived boolean"


def test_filter_is_strict(spark):
    df = spark.createDataFrame([("a/a", "c", 100, False), ("b/b", "c", 101, True), ("c/c", "c", 500, False)], CATALOG)
    assert names(catalog.filter_catalog(df)) == ["b/b", "c/c"]
    assert names(catalog.filter_catalog(df, exclude_archived=True)) == ["c/c"]


def test_top_repos_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"o/{i}", "py" if i % 3 else rng.choice(["c", "go"]), rng.randrange(50, 400), bool(i % 2)) for i in range(700)]
    got = catalog.top_repos(spark.createDataFrame(rows, CATALOG), " py, c ,,", 1).collect()
    want = []
    for lang in ("py", "c"):
        own = sorted((r for r in rows if r[1] == lang and r[2] > 100), key=lambda r: (-r[2], r[0]))
        want += [(r[0], place) for place, r in enumerate(own[:100], 1)]
    assert sorted((r["full_name"], r["position"]) for r in got) == sorted(want)


def excluded(spark, listed, strings, **options):
    df = spark.createDataFrame([(n, i) for i, n in enumerate(listed)], "full_name string, i int")
    ex = spark.createDataFrame([(s,) for s in strings], "s string")
    return names(catalog.exclude_by_substring(df, "full_name", ex, **options))


def test_exclusion_is_by_substring(spark):
    listed = ["a/b", "aa/bc", "c/d", "C/D"]
    assert excluded(spark, listed, ["a/b"]) == ["C/D", "c/d"]
    assert excluded(spark, listed, ["a/b"], exact=True) == ["C/D", "aa/bc", "c/d"]
    assert excluded(spark, listed, ["/"]) == []
    assert excluded(spark, listed, [""]) == []
    assert excluded(spark, listed, []) == sorted(listed)
    assert excluded(spark, listed, ["longer than any name"]) == sorted(listed)


@pytest.mark.parametrize("gram_size", [1, 2, 3, 5])
@pytest.mark.parametrize("shortest", [1, 2, 4])
def test_exclusion_against_brute_force(spark, gram_size, shortest):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ab/é\U0001f600") for _ in range(n))
    listed = [word(rng.randrange(1, 12)) for _ in range(300)] + ["aaaa"] * 100
    strings = [word(rng.randrange(shortest, 6)) for _ in range(25 if shortest > 1 else 2)]
    want = sorted(n for n in listed if not any(s in n for s in strings))
    assert excluded(spark, listed, strings, gram_size=gram_size) == want


def test_a_name_gives_no_more_rows_than_its_length(spark, monkeypatch):
    """Strings of thirty lengths: the index holds a row per place of a name, whatever their number."""
    kept, write = {}, catalog.settle
    monkeypatch.setattr(catalog, "settle", lambda df, label: kept.setdefault(label, write(df, label)))
    name = "".join(chr(0x4E00 + i) for i in range(200))
    assert excluded(spark, [name, "other"], [name[i : i + 3 + i] for i in range(30)]) == ["other"]
    assert kept["name-grams"].count() <= len(name) + len("other")
    assert kept["seeds"].count() == 30


def test_exclusion_compares_nothing_pairwise(spark, monkeypatch):
    df = spark.createDataFrame([("a/b",)], "full_name string")
    ex = spark.createDataFrame([("a",)], "s string")
    plans = []

    def look(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(catalog, "settle", look)
    plans.append(catalog.exclude_by_substring(df, "full_name", ex)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 5
    assert not any("NestedLoop" in plan or "Cartesian" in plan for plan in plans)


def test_distinct_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("B",)], "n string")
    assert [r["n"] for r in catalog.distinct_sorted(df, "n").collect()] == ["B", "a", "b"]


def test_integrity(spark):
    repos = spark.createDataFrame([("ok",), ("empty",), ("broken",), ("other",)], "repo string")
    commits = spark.createDataFrame(
        [("ok", "1", []), ("ok", "2", ["1"]), ("ok", "3", ["1", "2"]), ("broken", "4", ["1"]), ("other", "1", [])],
        "repo string, commit_id string, parents array<string>",
    )
    passed, failed = catalog.split_by_integrity(repos, commits)
    assert names(passed, "repo") == ["ok", "other"]
    assert {r["repo"]: r["reason"] for r in failed.collect()} == {"empty": "no commits", "broken": "missing parent"}


def test_integrity_reads_commits_once(spark, tmp_path):
    repos = spark.createDataFrame([("a",), ("b",), ("c",)], "repo string")
    commits = spark.createDataFrame([("a", "1", None), ("b", "2", ["1"])], "repo string, commit_id string, parents array<string>")
    commits.write.parquet(str(tmp_path / "commits"))
    judged = catalog.judge_integrity(repos, spark.read.parquet(str(tmp_path / "commits")))
    assert {r["repo"]: r["reason"] for r in judged.collect()} == {"a": None, "b": "missing parent", "c": "no commits"}
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_repository_list(spark):
    from commitloom.plans.repo_list import repository_list

    rows = [("o/b", "en", 900, False), ("o/a", "en", 800, False), ("o/a", "fr", 800, False), ("o/low", "en", 1, False), ("p/bad", "en", 700, False)]
    repos = spark.createDataFrame(rows, "full_name string, language string, stars long, archived boolean")
    bad = spark.createDataFrame([("bad",)], "s string")
    got = repository_list(repos, bad, ["en", "fr"], max_pages=1, min_stars=100)
    assert [r["full_name"] for r in got.collect()] == ["o/a", "o/b"]
    every = repository_list(repos, None, ["en"], max_pages=1, min_stars=100)
    assert [r["full_name"] for r in every.collect()] == ["o/a", "o/b", "p/bad"]
