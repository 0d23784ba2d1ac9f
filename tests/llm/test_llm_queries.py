"""The registered queries: names, contract columns, SQL twins, and the pipeline."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import rows_of
from shardloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, got) == rows_of(names, result.fetchall())


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    """Each stage on what the one before kept: columns, no new documents, decisions taken."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs, ids = documents, {r.doc_id for r in documents.select("doc_id").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids and len(left) > 100
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.dtypes == documents.dtypes
        if name == "secret_scans":
            assert left == ids and docs.where("text rlike '[0-9a-f]{32}'").count() == 0
        ids = left
    assert {"epoch", "size", "source_size", "target", "taken"} <= set(docs.columns)
