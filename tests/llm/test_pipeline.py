"""The pipeline keeps columns, applies each stage's decisions, and the SQL agrees."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from metricloom.llm.queries import QUERIES
from metricloom.llm.sql import SQL
from tests.conftest import SMALL
from tools.check import TABLES, canonical


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, SMALL), "stage")
        assert out.columns == docs.columns, name
        assert out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == docs.count() and last.where("not same").count() == 0


def test_stages_take_odd_rows(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long, lines long, near_tag int"
    good = " ".join(f"word{k}" for k in range(80))
    data = [(1, good, "en", "a", 5, 1, 1), (1, good, "en", "a", 5, 1, 1), (None, None, None, None, None, None, None),
            (2, "", None, None, 0, 0, 0), (None, good + " tail", None, "b", None, 2, 2)]
    odd = spark.createDataFrame(data, kind)
    for rows in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, SMALL)
            assert out.columns == odd.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, rows, SMALL).collect()


def test_registered():
    names = set(contract.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    mine, theirs = QUERIES[name](spark, SMALL).toPandas(), con.sql(SQL[name]).df()
    assert canonical(mine) == canonical(theirs)
