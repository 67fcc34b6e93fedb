"""The registered queries: their SQL, and the pipeline's stages."""

from pathlib import Path

import duckdb
import pytest
from helpers import documents, odd_rows

import __spark_entry__ as contract
import corpus_pipeline
from check import rows
from commitloom.llm.oracles import ORACLES
from commitloom.llm.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables are not here")


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(llm, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        db.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    got, want = QUERIES[name](llm, str(FOLDER)).toPandas(), db.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_per_document(llm, name):
    assert QUERIES[name](llm, str(FOLDER)).count() == llm.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_pipeline(llm):
    docs, counts = llm.read.parquet(f"{FOLDER}/documents.parquet"), []
    columns = docs.columns
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(llm, docs, str(FOLDER))
        if at < 4:
            assert out.columns == columns
        docs = llm.createDataFrame(out.toPandas(), out.schema)
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] and counts[3] == counts[4] > 0
    texts = {r["text"] for r in docs.collect()}
    assert len(texts) <= counts[2]
    assert corpus_pipeline.run(llm, str(FOLDER)).count() == counts[4]


@pytest.mark.parametrize("at", range(5))
def test_stages_take_awkward_rows(llm, at):
    stage = corpus_pipeline.STAGES[at][1]
    docs = documents(llm, odd_rows())
    assert stage(llm, docs, str(FOLDER)).count() <= 2 * len(odd_rows())
    assert stage(llm, docs.limit(0), str(FOLDER)).count() == 0
