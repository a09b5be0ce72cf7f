"""The registered queries: complete, and equal to their SQL on the supplied tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
import corpus_pipeline
from millrace.llm import registry as llm

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_DIR):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF_DIR}/{f}'")
    return con


def rows(table):
    names = sorted(table.column_names)
    return sorted(repr([r[n] for n in names]) for r in table.to_pylist())


def test_one_query_per_operator_and_the_pipeline():
    names = registry.queries()
    assert sorted(n.split("_")[0] for n in llm.queries()) == sorted(f"op{i}" for i in range(1, 14))
    assert set(llm.queries()) | {"pipeline"} <= set(names)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    have = llm.queries()[name](spark, SF_DIR).toArrow()
    want = duck.sql(llm.oracle_sql()[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in have.schema} == {f.name: str(f.type) for f in want.schema}
    assert have.num_rows > 0 and rows(have) == rows(want)
