import glob
import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as entries
import corpus_pipeline
from compare import normal
from tallyward.llm import toxicity

FOLDER = "/root/testdata/sf0.001"


def test_operators_are_registered():
    names = entries.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", [n for n in entries.oracle_sql() if n.startswith("op")])
def test_query_equals_sql(spark, db, name):
    got, want = entries.queries()[name](spark, FOLDER).toPandas(), db.execute(entries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        assert out.count() <= before and (out.columns == columns or k == 4)
        if name in ("line dedup", "tokens"):
            assert out.count() == before
        docs, before = out, out.count()
    row = docs.first()
    assert hashlib.sha256(bytes(row.ids)).hexdigest() == row.ids_sha256 and before > 100


def test_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "word " * 50000, "en", "s", 5), (2, "word " * 50000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert sorted((r.doc_id for r in docs.collect()), key=repr) == [1, 2, None]
    assert toxicity.THRESHOLD == 0.7


def test_toxic_documents_go(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    kept = {r.doc_id for r in corpus_pipeline.remove_toxic(spark, docs, FOLDER).collect()}
    assert kept == {d for d, s in scores.items() if s < toxicity.THRESHOLD}
