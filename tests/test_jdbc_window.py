"""The JDBC read window. The generated SELECTs run in Spark SQL here; no database is started."""

from datetime import datetime

import pytest

import millrace.sources.relation as relation
from millrace.plans import run_extract
from millrace.sources import JdbcSource, TableSpec, read_watermark

SPEC = TableSpec("moving", "k", jdbc=JdbcSource({"url": "jdbc:none"}, num_partitions=4))
DDL = "k long, updated_at timestamp_ntz"


def at(second):
    return datetime(2026, 5, 1, 0, 0, second)


@pytest.fixture
def database(spark, monkeypatch):
    """A table that takes on its next content before each data read."""
    log = {"later": [], "reads": []}

    def put(rows):
        spark.createDataFrame(rows, DDL).createOrReplaceTempView("moving")

    def jdbc(spark, source, dbtable, **extra):
        if "split_lo" not in dbtable:
            log["reads"].append(extra)
            if log["later"]:
                put(log["later"].pop(0))
        return spark.sql(f"select * from {dbtable}".replace('"', "`"))

    monkeypatch.setattr(relation, "_jdbc", jdbc)
    return put, log


def landed_keys(spark, layout, seq):
    rows = spark.read.parquet(f"{layout.landing('moving')}/seq={seq}").collect()
    return sorted(r.k for r in rows)


def test_row_changed_during_the_read_waits_for_the_next_run(spark, layout, database):
    put, log = database
    put([(1, at(1)), (2, at(2)), (3, at(3)), (9, None)])
    # Between the bounds query and the read, row 2 changes and row 4 appears.
    log["later"] = [[(1, at(1)), (2, at(30)), (3, at(3)), (4, at(31)), (9, None)]]
    assert run_extract(spark, SPEC, layout) == 3
    assert landed_keys(spark, layout, 0) == [1, 3, 9]
    assert read_watermark(spark, layout.state("extract", "moving"))[1:] == (at(3), "3")
    assert run_extract(spark, SPEC, layout) == 2
    assert landed_keys(spark, layout, 1) == [2, 4]
    assert run_extract(spark, SPEC, layout) == 0


def test_ties_of_the_mark_are_read_and_ranges_follow_the_window(spark, layout, database):
    put, log = database
    put([(1, at(1)), (2, at(2))])
    run_extract(spark, SPEC, layout)
    put([(1, at(1)), (2, at(2)), (3, at(2)), (4, at(5))])
    assert run_extract(spark, SPEC, layout) == 2
    first, second = log["reads"]
    assert first["lowerBound"].endswith(":01") and first["upperBound"].endswith(":02")
    assert second["lowerBound"].endswith(":02") and second["upperBound"].endswith(":05")
    assert second["numPartitions"] == 4 and second["partitionColumn"] == "updated_at"


def test_newest_rows_may_have_gone(spark, layout, database):
    put, log = database
    put([(1, at(1)), (2, at(2))])
    run_extract(spark, SPEC, layout)
    put([(1, at(1))])
    assert run_extract(spark, SPEC, layout) == 0
    assert log["reads"][1]["lowerBound"] <= log["reads"][1]["upperBound"]


def test_sources_without_times(spark, layout, database):
    put, log = database
    put([(1, None)])
    assert run_extract(spark, SPEC, layout) == 1
    put([])
    assert run_extract(spark, TableSpec("moving", "k", "select * from moving;", SPEC.jdbc), layout) == 0
    assert "numPartitions" not in log["reads"][0]
