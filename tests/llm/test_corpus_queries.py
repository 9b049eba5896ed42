import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from factpanel.llm import oracle, queries
from factpanel.queries import BASE_TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not there")


def test_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert sorted(n.split("_")[0] for n in queries.queries()) == sorted(f"op{i}" for i in range(1, 14))


@pytest.mark.parametrize("name", list(oracle.oracle_sql()))
def test_query_against_sql(spark, name):
    db = duckdb.connect()
    for t in BASE_TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    cursor = db.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = [tuple(r[columns.index(c)] for c in df.columns) for r in cursor.fetchall()]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(expected, key=str)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < docs.count() <= before
        before = docs.count()
    texts = [r.text for r in docs.collect()]
    assert len({(t or "").lower() for t in texts}) == len(texts)
    found = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in found} == {r.doc_id for r in docs.collect()}
    total: dict = {}
    for r in found:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert total[r.doc_id] <= r.doc_tokens
