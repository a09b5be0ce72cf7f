"""Physical plans: what is pushed down, what is shuffled, and how hot keys spread."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from factory_views import view
from millrace.operators import (
    advance_watermark,
    deterministic_sort,
    drop_exact_duplicates,
    latest_by_key,
    scan_since,
)
from millrace.plans import MARTS, build_mart, marts, conform, panel_machine, read_states, time_range
from millrace.sources import append_version, as_of, land, with_version
from millrace.streaming import run_transform

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def line(text, start):
    return next(s for s in text.splitlines() if s.startswith(start))


LAZY = [
    n
    for n in registry.table_queries()
    if n.startswith(("scan_since", "scan_full", "panel", "mart_s", "mart_a", "latest", "picker", "drop"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(registry.table_queries()[name](spark, SF))
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop", "Broadcast"):
        assert word not in text


def test_compound_mark_is_pushed_down(spark):
    df = scan_since(view(spark, SF, "orders"), "o_orderdate", datetime(1998, 1, 1), "o_orderkey", 7)
    pushed = line(plan(df), "PushedFilters")
    assert "Or(GreaterThan(o_orderdate" in pushed and "GreaterThan(o_orderkey,7)" in pushed


def test_mark_reads_two_columns_and_sends_one_row_per_task(spark):
    text = plan(advance_watermark(view(spark, SF, "orders"), "o_orderdate", "o_orderkey"))
    assert line(text, "ReadSchema") == "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>"
    assert "IsNotNull(o_orderdate)" in line(text, "PushedFilters") and "partial_max" in text


def test_no_run_changes_the_session(spark, layout):
    before = dict(spark.conf.getAll)
    land(spark.range(2000), layout.landing("t"), 0)
    assert run_transform(spark, "t", layout) == 2000
    assert dict(spark.conf.getAll) == before


def test_work_folder_needs_a_shared_parent(spark, monkeypatch):
    assert registry.work_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        registry.work_dir(Cluster)


def test_only_wanted_versions_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in range(2):
        append_version(spark.range(3), path, v)
    files = as_of(spark, path, 0).inputFiles()
    assert files and all("_delta_version=0" in f for f in files)


def test_latest_mart_reads_only_what_it_needs(spark, layout):
    for v, name in enumerate(("fact_production_orders", "order_changes")):
        rows = conform(with_version(view(spark, SF, name), v), "fact_production_orders")
        append_version(rows, layout.warehouse("fact_production_orders"), v)
    rows = marts._mart_rows(as_of(spark, layout.warehouse("fact_production_orders")), MARTS["mv_production_daily"])
    text = plan(latest_by_key(rows, ["order_id"]))
    read = line(text, "ReadSchema")
    assert read.count(":") - 1 == 5  # key, two quantities, start and update time; the version is the folder
    assert "product_sku" not in read and "status" not in read


def test_mart_reads_only_its_columns_with_one_shuffle(spark):
    text = plan(registry.table_queries()["mart_anomaly_daily"](spark, SF))
    assert line(text, "ReadSchema") == "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>"
    assert "partial_sum" in text and text.count(") Exchange\n") == 1


def test_panel_filters_reach_the_stored_mart(spark, layout):
    orders = view(spark, SF, "fact_production_orders")
    path = layout.warehouse("fact_production_orders")
    append_version(conform(with_version(orders, 0), "fact_production_orders"), path, 0)
    build_mart(spark, layout, "mv_machine_daily")
    states = read_states(spark, layout, "mv_machine_daily")
    pushed = line(plan(panel_machine(states, "MCH-000007")), "PushedFilters")
    assert "EqualTo(machine_id,MCH-000007)" in pushed
    ranged = time_range(states, "order_date", "1998-01-01", "1998-06-30")
    pushed = line(plan(panel_machine(ranged)), "PushedFilters")
    assert "GreaterThanOrEqual(order_date,1998-01-01)" in pushed


def test_rank_filter_runs_before_the_shuffle(spark):
    text = plan(latest_by_key(view(spark, SF, "orders_log"), ["order_id"]), "simple")
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_copies_collapse_before_the_shuffle(spark):
    text = plan(drop_exact_duplicates(view(spark, SF, "lineitem")), "simple")
    assert "HashAggregate" in text[text.index("Exchange") :]


@pytest.fixture
def hot(spark):
    """A third of the rows under one key."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("machine_id"),
        F.lit("2026-05-01").cast("timestamp_ntz").alias("updated_at"),
        F.col("id").alias("v"),
        F.lit(0).cast("long").alias("_delta_version"),
    ).repartition(8)


def test_hot_sort_key_is_split(spark, hot):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = (
            deterministic_sort(hot).groupBy(F.spark_partition_id()).count().toPandas()["count"].tolist()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 30_000 and max(sizes) < 10_000


def test_hot_key_keeps_its_newest_row(hot):
    newest = latest_by_key(hot, ["machine_id"], tie=["updated_at", "v"])
    assert newest.count() == 20_001
    assert newest.filter("machine_id = 0").first().v == 29_997
