"""Reading and writing."""

import gzip
import json
import random
from pathlib import Path
from urllib.parse import unquote, urlparse

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from commitloom.schemas import COMMIT_RECORD
from commitloom.sources import jsonl, repo_list

SCHEMA = StructType([StructField("a", StringType()), StructField("n", LongType()), StructField("l", ArrayType(StringType()))])
GOOD = ['{"a":"x","n":1,"l":["p","q"]}', '{"a":null}', '  {"a":"y\\u00e9\\n"} ', '{"b":1,"a":"z"}', "{}"]
BAD = [
    '{"a":"x"', '{"a":"x"} junk', '{"a":"x"}{"a":"z"}', '{"a":"x"}]', "{'a':'x'}", '{"a":"x",}', "{a:1}",
    '{"a":"x"},"b":9}', '{"a":"x"},"whole":1}', '{"a":"x"},"row":{"a":"y"}', '{"a":"x"},{"a":"y"}', '{"a":"t\tab"}', "123", "null", '"s"', '[{"a":"x"}]', "junk", '{"a":01}',
]


def write(tmp_path, lines, name="f.jsonl"):
    (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path)


def test_bad_and_blank_lines_are_skipped(spark, tmp_path):
    path = write(tmp_path, [*GOOD, "", "   ", *BAD])
    got = jsonl.read_jsonl(spark, path, SCHEMA).collect()
    want = [("x", 1, ["p", "q"]), (None, None, None), ("yé\n", None, None), ("z", None, None), (None, None, None)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("columns", [["a"], ["n"], ["l"], ["a", "n"]])
def test_pruned_columns_do_not_change_the_rows(spark, tmp_path, columns):
    path = write(tmp_path, [*GOOD, *BAD])
    df = jsonl.read_jsonl(spark, path, SCHEMA)
    assert df.select(*columns).count() == len(df.select(*columns).collect()) == df.count() == len(GOOD)


@pytest.mark.parametrize("line", BAD)
def test_fail_mode_stops_at_a_bad_line(spark, tmp_path, line):
    path = write(tmp_path, [*GOOD, line])
    with pytest.raises(PySparkException, match="not a JSON record"):
        jsonl.read_jsonl(spark, path, SCHEMA, mode="fail").collect()


def test_fail_mode_reads_good_files(spark, tmp_path):
    assert jsonl.read_jsonl(spark, write(tmp_path, GOOD), SCHEMA, mode="fail").count() == len(GOOD)


def test_mode_is_checked(spark):
    with pytest.raises(ValueError):
        jsonl.read_jsonl(spark, "x", SCHEMA, mode="other")


def test_only_matching_files_of_a_folder(spark, tmp_path):
    write(tmp_path, ['{"a":"1"}'], "one.jsonl")
    write(tmp_path, ['{"a":"2"}'], "two.jsonl")
    write(tmp_path, ['{"a":"3"}'], "three.txt")
    assert sorted(r["a"] for r in jsonl.read_jsonl(spark, str(tmp_path), SCHEMA).collect()) == ["1", "2"]


def test_write_keeps_null_members(spark, tmp_path):
    path = str(tmp_path / "out")
    jsonl.write_jsonl(spark.createDataFrame([("x", None, ["é"])], SCHEMA).coalesce(1), path)
    lines = [l for f in (tmp_path / "out").glob("part-*") for l in f.read_text(encoding="utf-8").splitlines()]
    assert [json.loads(l) for l in lines] == [{"a": "x", "n": None, "l": ["é"]}]


def test_by_repo_round_trip(spark, tmp_path):
    rows = [(f"own{i % 3}/same", f"m{i}", None if i % 2 else "d") for i in range(30)]
    df = spark.createDataFrame(rows, "repo string, commit_msg string, change string")
    path = str(tmp_path / "out")
    jsonl.write_by_repo(df, path)
    assert sorted(p.name for p in (tmp_path / "out").glob("repo=*")) == [f"repo=own{i}%2Fsame" for i in range(3)]
    back = spark.read.json(path).select("repo", "commit_msg", "change")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)


def test_record_schema_reads_a_record(spark, tmp_path):
    path = write(tmp_path, ['{"commit_msg":"m","change":"c","affected_files":["a","b"],"extra":1}'])
    row = jsonl.read_jsonl(spark, path, COMMIT_RECORD).first()
    assert (row["commit_msg"], row["affected_files"], row["repo_source"]) == ("m", ["a", "b"], None)


def test_repo_list(spark, tmp_path):
    (tmp_path / "list.txt").write_text("  a/b \n# c/d\n\n   \n  #e/f\nplain\ng/h\n\tg/i\t")
    got = repo_list.read_repo_list(spark, str(tmp_path / "list.txt"))
    assert sorted(r["full_name"] for r in got.collect()) == ["a/b", "g/h", "g/i"]
    repo_list.write_repo_list(got, str(tmp_path / "out"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a/b", "g/h", "g/i"]


def test_members_outside_the_schema_come_through(spark, tmp_path):
    lines = ['{"a":"x  y","n":null,"o":{"b":[1,"é"]}}', '{"a":7,"extra":true}', '{"n":3}', "junk", '{"a":"z","n":"text"}']
    source, target = write(tmp_path, lines), str(tmp_path / "out")
    schema = StructType([StructField("a", StringType()), StructField("n", LongType())])
    df = jsonl.read_jsonl(spark, source, schema, glob="f.jsonl", whole_line="_line")
    jsonl.write_jsonl(df.selectExpr("upper(a) as a", "n", "_line"), target, whole_line="_line")
    got = [json.loads(r["value"]) for r in spark.read.text(target).collect()]
    want = [{"a": "X  Y", "n": None, "o": {"b": [1, "é"]}}, {"a": 7, "extra": True}, {"n": 3}, {"a": "Z", "n": "text"}]
    assert len(got) == len(want) and all(line in got for line in want)
    assert jsonl.read_jsonl(spark, target, schema, mode="fail").count() == 4


def test_normalise_stage_from_file_to_file(spark, tmp_path):
    from commitloom.plans.normalize_jsonl import normalize_jsonl

    (tmp_path / "in").mkdir()
    write(tmp_path / "in", ['{"commit_msg":"a  b\\r\\nc","change":5,"more":"x  y"}'])
    normalize_jsonl(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["commit_msg", "change"])
    (row,) = spark.read.text(str(tmp_path / "out")).collect()
    assert json.loads(row["value"]) == {"commit_msg": "a b\nc", "change": 5, "more": "x  y"}


def test_rejects_have_their_line_numbers(spark, tmp_path):
    """Many files, one of them larger than a split, and one compressed: numbers as a plain count gives them."""
    rng = random.Random(2)
    want = []
    for k in range(7):
        lines = [rng.choice([*GOOD, *BAD, "", " \t", '{"a":"' + "é" * rng.randrange(90) + '"}']) for _ in range(2000 if k == 3 else 40)]
        data = ("\n".join(lines) + ("\n" if k % 2 else "")).encode()
        name = f"f{k}.jsonl" + (".gz" if k == 5 else "")
        (tmp_path / name).write_bytes(gzip.compress(data) if k == 5 else data)
        kept = lines if lines[-1] or k % 2 else lines[:-1]
        bad = [(i, line) for i, line in enumerate(kept, 1) if line not in GOOD and not line.startswith('{"a":"é') and line != '{"a":""}']
        want += [(name, i, line, "blank" if not line.strip() else "not a JSON record") for i, line in bad]
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows, rejects = jsonl.read_jsonl_with_rejects(spark, str(tmp_path), SCHEMA)
        got = [(r["file"].rsplit("/", 1)[1], r["line_no"], r["line"], r["reason"]) for r in rejects.collect()]
        assert sorted(got) == sorted(want)
        assert spark.read.text(str(tmp_path / "f3.jsonl")).rdd.getNumPartitions() > 3
        plain = jsonl.read_jsonl(spark, str(tmp_path), SCHEMA)
        assert sorted(map(tuple, rows.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_rejects_of_clean_files(spark, tmp_path):
    rows, rejects = jsonl.read_jsonl_with_rejects(spark, write(tmp_path, GOOD), SCHEMA, whole_line="line")
    assert rows.count() == len(GOOD) and "line" in rows.columns and rejects.count() == 0


ORDERED = StructType([StructField("n", LongType()), StructField("text", StringType())])


def ordered_rows(hot, others=6):
    rng = random.Random(9)
    rows = [("hot/one", i, f"t{i}") for i in range(hot)] + [(f"o/{k}", i, f"t{i}") for k in range(others) for i in range(5)]
    rng.shuffle(rows)
    return rows


def files_of(path):
    return {str(f.relative_to(path)): f.read_bytes() for f in path.rglob("*") if f.is_file()}


def test_parts_hold_a_repository_in_order(spark, tmp_path):
    rows = ordered_rows(900)
    path = tmp_path / "out"
    df = spark.createDataFrame(rows, "repo string, n long, text string").repartition(7)
    jsonl.write_ordered_by_repo(df, str(path), [F.col("n").desc()], part_rows=70)
    parts = sorted((r["repo"], r["part"], r["file"], r["bytes"]) for r in jsonl.manifest(spark, str(path)).collect())
    hot = [p for p in parts if p[0] == "hot/one"]
    assert [p[1] for p in hot] == list(range(1, len(hot) + 1)) and len(hot) >= 900 // 70
    found = []
    for _, _, file, size in hot:
        data = Path(unquote(urlparse(file).path)).read_bytes()
        lines = data.decode().splitlines()
        assert len(data) == size and len(lines) <= 70
        found += [json.loads(line)["n"] for line in lines]
    assert found == list(range(899, -1, -1))
    back = jsonl.read_ordered(spark, str(path), ORDERED).collect()
    want = {(repo, n): (900 if repo == "hot/one" else 5) - n for repo, n, _ in rows}
    assert {(r["repo"], r["n"]): r["position"] for r in back} == want and len(back) == len(rows)


def test_a_rerun_leaves_other_repositories_alone(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.createDataFrame(ordered_rows(300), "repo string, n long, text string")
    jsonl.write_ordered_by_repo(df, str(path), [F.col("n")], part_rows=40)
    before = files_of(path)
    fewer = df.filter("repo in ('hot/one', 'o/2') and n < 3").withColumn("text", F.lit("again"))
    for _ in range(2):
        jsonl.write_ordered_by_repo(fewer, str(path), [F.col("n")], only_these=True)
    after = files_of(path)
    others = {name for name in before if name.startswith("repo=o%2F") and not name.startswith("repo=o%2F2")}
    assert others and all(after[name] == before[name] for name in others)
    assert not any(name in after for name in before if name.startswith(("repo=hot", "repo=o%2F2/part")))
    back = jsonl.read_ordered(spark, str(path), ORDERED)
    assert {(r["repo"], r["n"]) for r in back.filter("text = 'again'").collect()} == {(p, n) for p in ("hot/one", "o/2") for n in range(3)}
    assert back.count() == 6 + 5 * 5


def test_a_run_that_fails_leaves_the_folder(spark, tmp_path):
    path = tmp_path / "out"
    df = spark.createDataFrame(ordered_rows(30), "repo string, n long, text string")
    jsonl.write_ordered_by_repo(df, str(path), [F.col("n")])
    before = files_of(path)
    broken = df.withColumn("text", F.when(F.col("n") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("text")))
    with pytest.raises(PySparkException, match="stop"):
        jsonl.write_ordered_by_repo(broken, str(path), [F.col("n")], only_these=True)
    assert {k: v for k, v in files_of(path).items() if k.startswith("repo=")} == {k: v for k, v in before.items() if k.startswith("repo=")}


def test_rows_without_a_repository_are_one(spark, tmp_path):
    rows = [(None, 2, "b"), ("", 1, "a"), ("r", 1, "c")]
    jsonl.write_ordered_by_repo(spark.createDataFrame(rows, "repo string, n long, text string"), str(tmp_path / "out"), [F.col("n")])
    back = jsonl.read_ordered(spark, str(tmp_path / "out"), ORDERED).collect()
    assert sorted((r["repo"] or "", r["position"], r["text"]) for r in back if r["repo"]) == [("r", 1, "c")]
    assert len(back) == 1 + 2


def test_judged_lines_are_written_once(spark, tmp_path, monkeypatch):
    """A good line as its members, a rejected one as it stands."""
    seen, settle = [], jsonl.settle
    monkeypatch.setattr(jsonl, "settle", lambda df, label: seen.append(settle(df, label)) or seen[-1])
    jsonl.read_jsonl_with_rejects(spark, write(tmp_path, [*GOOD, "junk", " "]), SCHEMA)
    kept = sorted((r["_good"], r["value"], r["parsed"] is None) for r in seen[0].filter("not _good").collect())
    assert kept == [(False, " ", True), (False, "junk", True)]
    assert seen[0].filter("_good and value is null and parsed is not null").count() == len(GOOD)


@pytest.mark.parametrize("name", ["jsonl_scan_skip"])
def test_repeated_lines_are_packed(spark, tmp_path, name):
    from workload.queries import QUERIES

    spark.sql("select id as doc_id, concat('text ', id) as text, 'en' as lang from range(40)").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES[name](spark, str(tmp_path))
    assert found.count() == 40 and all(f.endswith(".txt.snappy") for f in found.inputFiles())


def test_parts_have_no_checksum_files_beside_them(spark, tmp_path):
    df = spark.createDataFrame(ordered_rows(30), "repo string, n long, text string")
    jsonl.write_by_repo(df, str(tmp_path / "plain"))
    jsonl.write_ordered_by_repo(df, str(tmp_path / "ordered"), [F.col("n")], part_rows=10)
    jsonl.write_ordered_by_repo(df, str(tmp_path / "ordered"), [F.col("n")], only_these=True)
    assert not list(tmp_path.rglob("*.crc")) and len(list(tmp_path.rglob("repo=*/part-*.json"))) >= 14


def test_ordered_files_are_opened_once(spark, tmp_path, monkeypatch):
    """What is read back comes from the settled lines, which no other scan of the folder joins."""
    df = spark.createDataFrame(ordered_rows(90), "repo string, n long, text string")
    jsonl.write_ordered_by_repo(df, str(tmp_path / "out"), [F.col("n")], part_rows=20)
    monkeypatch.setattr(jsonl, "manifest", None)
    back = jsonl.read_ordered(spark, str(tmp_path / "out"), ORDERED)
    assert not any(file.endswith(".json") for file in back.inputFiles())
    assert {(r["repo"], r["n"], r["position"]) for r in back.collect()} == {(repo, n, n + 1) for repo, n, _ in ordered_rows(90)}


def test_files_are_not_listed_on_the_driver_where_they_have_lines(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame(ordered_rows(30), "repo string, n long, text string")
    jsonl.write_by_repo(df, str(tmp_path / "out"))
    monkeypatch.setattr(type(df), "inputFiles", lambda _: pytest.fail("all names came to the driver"))
    assert jsonl.read_jsonl(spark, str(tmp_path / "out"), ORDERED, mode="fail").count() == 30 + 6 * 5


def test_a_line_is_parsed_once(spark):
    """Its members and the columns put in are parsed once a row, not once a member."""
    df = spark.createDataFrame([("x", '{"a":1,"b":2}')], "a string, line string")
    plan = jsonl._merged(df, "line")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 2 and plan.count("variant_get") == 2
