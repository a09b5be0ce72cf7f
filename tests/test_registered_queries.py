"""Every registered query against its SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as registry

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in os.listdir(SF_DIR):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF_DIR}/{f}'")
    return con


def rows(table) -> list[str]:
    columns = sorted(table.column_names)
    return sorted(repr([r[c] for c in columns]) for r in table.to_pylist())


def kinds(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def test_every_query_has_a_check():
    assert set(registry.table_queries()) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", list(registry.table_queries()))
def test_query_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF_DIR)
    want = duck.sql(registry.oracle_sql()[name]).to_arrow_table()
    have = got.toArrow()
    assert kinds(have) == kinds(want)
    assert have.num_rows > 0
    assert rows(have) == rows(want)


def test_entry(spark):
    panel = registry.entry(spark)
    assert panel.columns == ["reading_date", "anomalies", "total_readings", "anomaly_rate_pct"]
    assert panel.count() > 0
