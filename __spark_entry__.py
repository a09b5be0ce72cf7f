"""Registered queries and the SQL each one is checked against."""

from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from factory_views import check_sql, register, view  # noqa: E402
from millrace.operators import (  # noqa: E402
    advance_watermark,
    aggregate,
    cast_time_columns,
    concat_strict,
    deterministic_sort,
    drop_exact_duplicates,
    latest_by_key,
    partial,
    scan_since,
    to_naive_utc,
)
from millrace.plans import (  # noqa: E402
    MARTS,
    anomaly_band,
    build_mart,
    conform,
    fold_mart,
    latest_table,
    panel_anomaly,
    panel_machine,
    panel_production,
    panel_sensor,
    picker,
    read_mart,
    read_states,
    refresh_mart,
    refresh_marts,
    run_extract,
    run_load,
    run_pipeline,
    sensor_bands,
    stream_load,
    time_range,
)
from millrace.sources import (  # noqa: E402
    Layout,
    TableSpec,
    added_since,
    append_version,
    as_of,
    as_of_time,
    current_version,
    land,
    scan_full,
    scan_landing,
    scan_new_files,
    scan_query,
    versions,
    with_version,
)
from millrace.sources.files import numbered, session_dir  # noqa: E402
from millrace.streaming import run_transform, stream_transform  # noqa: E402

try:
    import corpus_pipeline
    from millrace.llm import registry as llm
except ImportError:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]

MARK = datetime(1998, 1, 1)
MARK_KEY = 1416
RANGE = ("2024-01-10 06:00:00", "2024-01-20 18:00:00")
MACHINE = "MCH-000007"
SENSOR = "MCH-000003-S13"


def work_dir(spark: SparkSession) -> str:
    """A new folder below the shared folder the cluster names; only local mode may use a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return session_dir(spark, shared)


# ---- scans and extraction -------------------------------------------------------------------------


def q_scan_full(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, "fact_production_orders")
    return scan_full(spark, TableSpec("fact_production_orders"))


QUERY_TEXT = """select order_id, machine_id, status, target_qty, updated_at
 from fact_production_orders where status <> 'F'"""


def q_scan_query(spark: SparkSession, sf: str) -> DataFrame:
    register(spark, sf, "fact_production_orders")
    return scan_query(spark, TableSpec("open_orders", query=f"{QUERY_TEXT} ; "))


def q_scan_since_ts(spark: SparkSession, sf: str) -> DataFrame:
    return scan_since(view(spark, sf, "orders"), "o_orderdate", MARK)


def q_scan_since_ts_key(spark: SparkSession, sf: str) -> DataFrame:
    return scan_since(view(spark, sf, "orders"), "o_orderdate", MARK, "o_orderkey", MARK_KEY)


def q_watermark_advance(spark: SparkSession, sf: str) -> DataFrame:
    orders = view(spark, sf, "fact_production_orders")
    return advance_watermark(orders, "updated_at", "order_id", (MARK, "ORD-0"))


def _landed(spark: SparkSession, sf: str, layout: Layout, step: Callable[[], object]) -> DataFrame:
    orders = view(spark, sf, "fact_production_orders")
    changes = view(spark, sf, "order_changes")
    path = layout.landing("orders")
    land(orders, path, 0)
    step()
    land(changes, path, 1)
    step()
    return orders


def q_scan_landing(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    orders = _landed(spark, sf, layout, lambda: None)
    orders.limit(7).write.parquet(f"{layout.landing('orders')}/seq=2")  # a torn batch is not read
    return scan_landing(spark, layout.landing("orders"))


def q_scan_new_files(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    _landed(spark, sf, layout, lambda: None)
    return scan_new_files(spark, layout.landing("orders"), 0)


# ---- cleaning -------------------------------------------------------------------------------------


def q_cast_time_columns(spark: SparkSession, sf: str) -> DataFrame:
    raw = view(spark, sf, "fact_sensor_readings").selectExpr(
        "* except (reading_timestamp, created_at, updated_at)",
        "cast(reading_timestamp as string) || if(reading_id % 2 = 0, '+02:00', '') as Reading_Timestamp",
        "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', created_at) as created_at",
        "cast(updated_at as date) as updated_at",
    )
    return cast_time_columns(raw)


def q_to_naive_utc(spark: SparkSession, sf: str) -> DataFrame:
    zoned = view(spark, sf, "fact_sensor_readings").selectExpr(
        "* except (reading_timestamp)",
        "cast(cast(reading_timestamp as string) || '+02:00' as timestamp_ltz) as reading_timestamp",
    )
    return to_naive_utc(zoned)


def q_drop_exact_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    lines = view(spark, sf, "lineitem")
    return drop_exact_duplicates(lines.union(lines.filter("l_linenumber > 2")))


def q_deterministic_sort(spark: SparkSession, sf: str) -> DataFrame:
    return deterministic_sort(view(spark, sf, "fact_production_orders"))


def q_concat_strict(spark: SparkSession, sf: str) -> DataFrame:
    return concat_strict(
        view(spark, sf, "fact_production_orders"), view(spark, sf, "order_changes")
    )


# ---- versioned tables -----------------------------------------------------------------------------


def _log_table(spark: SparkSession, sf: str) -> str:
    path = Layout(work_dir(spark)).table("orders")
    append_version(view(spark, sf, "fact_production_orders"), path, 0)
    append_version(view(spark, sf, "order_changes"), path, 1)
    return path


def q_append_version(spark: SparkSession, sf: str) -> DataFrame:
    return as_of(spark, _log_table(spark, sf))


def q_current_version(spark: SparkSession, sf: str) -> DataFrame:
    path = _log_table(spark, sf)
    current = current_version(spark, path)
    return added_since(spark, path, current - 1).groupBy(
        F.col("_delta_version").alias("current_version")
    ).agg(F.count(F.lit(1)).alias("rows_added"))


def q_versions(spark: SparkSession, sf: str) -> DataFrame:
    return versions(spark, _log_table(spark, sf))


def q_added_since(spark: SparkSession, sf: str) -> DataFrame:
    return added_since(spark, _log_table(spark, sf), 0)


def q_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return as_of(spark, _log_table(spark, sf), 0)


def q_as_of_time(spark: SparkSession, sf: str) -> DataFrame:
    """The table as it was between its two versions, and (no rows) before the first."""
    path = Layout(work_dir(spark)).table("orders")
    before = datetime.now(UTC).replace(tzinfo=None)
    append_version(view(spark, sf, "fact_production_orders"), path, 0)
    between = datetime.now(UTC).replace(tzinfo=None)
    append_version(view(spark, sf, "order_changes"), path, 1)
    return as_of_time(spark, path, between).unionByName(as_of_time(spark, path, before))


def q_as_of_unmarked(spark: SparkSession, sf: str) -> DataFrame:
    """A version without commit record is left out, whatever its number and whatever lies in it."""
    path = Layout(work_dir(spark)).table("orders")
    torn = view(spark, sf, "fact_production_orders").filter("status = 'F'")
    torn.write.parquet(numbered(path, "_delta_version", 0))
    append_version(view(spark, sf, "order_changes"), path, 1)
    torn.write.parquet(numbered(path, "_delta_version", 2))
    return as_of(spark, path)


def q_latest_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return latest_by_key(view(spark, sf, "orders_log"), ["order_id"])


def q_latest_by_key_ties(spark: SparkSession, sf: str) -> DataFrame:
    lines = view(spark, sf, "lineitem")
    rest = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    return latest_by_key(lines, ["l_orderkey"], "l_linenumber", ["l_shipdate", *rest])


def q_conform(spark: SparkSession, sf: str) -> DataFrame:
    readings = view(spark, sf, "fact_sensor_readings")
    text = readings.withColumn("reading_value", F.col("reading_value").cast("string"))
    return conform(with_version(text, 3), "fact_sensor_readings")


# ---- marts and panels -----------------------------------------------------------------------------


def _mart(name: str, source: str) -> Query:
    return lambda spark, sf: aggregate(view(spark, sf, source), MARTS[name])


def _states(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return partial(view(spark, sf, MARTS[name].source), MARTS[name])


def _loaded(spark: SparkSession, sf: str, layout: Layout, v: int) -> None:
    """Load one version of the orders; version 1 holds the changes."""
    rows = view(spark, sf, ("fact_production_orders", "order_changes")[v])
    path = layout.warehouse("fact_production_orders")
    append_version(conform(with_version(rows, v), "fact_production_orders"), path, v)


def q_mart_incremental_refresh(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    for v in (0, 1):
        _loaded(spark, sf, layout, v)
        refresh_mart(spark, layout, "mv_machine_daily")
    return read_mart(spark, layout, "mv_machine_daily")


def q_mart_folded(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    for v in (0, 1):
        _loaded(spark, sf, layout, v)
        refresh_mart(spark, layout, "mv_machine_daily")
    fold_mart(spark, layout, "mv_machine_daily")
    return read_mart(spark, layout, "mv_machine_daily")


def q_mart_backfill(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    for v in (0, 1):
        _loaded(spark, sf, layout, v)
    build_mart(spark, layout, "mv_production_daily")
    return read_mart(spark, layout, "mv_production_daily")


def q_mart_latest(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    for v in (0, 1):
        _loaded(spark, sf, layout, v)
    build_mart(spark, layout, "mv_production_daily", mode="latest")
    return read_mart(spark, layout, "mv_production_daily", mode="latest")


def q_mart_added_later(spark: SparkSession, sf: str) -> DataFrame:
    """A mart whose first refresh comes after loads that did not feed it covers them all."""
    layout = Layout(work_dir(spark))
    _loaded(spark, sf, layout, 0)
    refresh_mart(spark, layout, "mv_machine_daily")
    _loaded(spark, sf, layout, 1)
    refresh_marts(spark, layout, "fact_production_orders")
    return read_mart(spark, layout, "mv_production_daily")


def q_mart_latest_after_load(spark: SparkSession, sf: str) -> DataFrame:
    """A mart of newest rows follows the next load."""
    layout = Layout(work_dir(spark))
    _loaded(spark, sf, layout, 0)
    build_mart(spark, layout, "mv_production_daily", mode="latest")
    _loaded(spark, sf, layout, 1)
    refresh_marts(spark, layout, "fact_production_orders")
    return read_mart(spark, layout, "mv_production_daily", mode="latest")


READING_LOADS = ("fact_sensor_readings", "reading_fixes", "reading_drops")


def _reading_loads(spark: SparkSession, sf: str, layout: Layout, mode: str) -> None:
    """Load the readings in three versions and refresh their hourly mart after each."""
    path = layout.warehouse("fact_sensor_readings")
    for v, name in enumerate(READING_LOADS):
        append_version(conform(with_version(view(spark, sf, name), v), "fact_sensor_readings"), path, v)
        refresh_mart(spark, layout, "mv_sensor_hourly", mode)


def q_mart_latest_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Updates take rows back from sums, counts, averages and extremes of the newest rows."""
    layout = Layout(work_dir(spark))
    _reading_loads(spark, sf, layout, "latest")
    return read_mart(spark, layout, "mv_sensor_hourly", "latest")


def q_mart_latest_folded(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    _reading_loads(spark, sf, layout, "latest")
    fold_mart(spark, layout, "mv_sensor_hourly", "latest")
    return read_mart(spark, layout, "mv_sensor_hourly", "latest")


def q_panel_time_range_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """The panel reads the stored states of the months in its range only."""
    layout = Layout(work_dir(spark))
    _reading_loads(spark, sf, layout, "append")
    return panel_sensor(time_range(read_states(spark, layout, "mv_sensor_hourly"), "reading_hour", *RANGE))


def q_mart_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """A replacement is built beside the mart and then put in its place."""
    layout = Layout(work_dir(spark))
    _loaded(spark, sf, layout, 0)
    build_mart(spark, layout, "mv_machine_daily")
    _loaded(spark, sf, layout, 1)
    build_mart(spark, layout, "mv_machine_daily", replace=True)
    return read_mart(spark, layout, "mv_machine_daily")


def q_panel_production(spark: SparkSession, sf: str) -> DataFrame:
    return panel_production(_states(spark, sf, "mv_production_daily"))


def q_panel_machine(spark: SparkSession, sf: str) -> DataFrame:
    return panel_machine(_states(spark, sf, "mv_machine_daily"))


def q_panel_machine_one(spark: SparkSession, sf: str) -> DataFrame:
    return panel_machine(_states(spark, sf, "mv_machine_daily"), MACHINE)


def q_panel_sensor(spark: SparkSession, sf: str) -> DataFrame:
    return panel_sensor(_states(spark, sf, "mv_sensor_hourly"))


def q_panel_sensor_one(spark: SparkSession, sf: str) -> DataFrame:
    return panel_sensor(_states(spark, sf, "mv_sensor_hourly"), SENSOR)


def q_panel_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return panel_anomaly(_states(spark, sf, "mv_anomaly_daily"))


def q_picker_machine(spark: SparkSession, sf: str) -> DataFrame:
    return picker(_states(spark, sf, "mv_machine_daily"), "machine_id")


def q_picker_sensor(spark: SparkSession, sf: str) -> DataFrame:
    return picker(_states(spark, sf, "mv_sensor_hourly"), "sensor_id")


def q_panel_time_range(spark: SparkSession, sf: str) -> DataFrame:
    return panel_sensor(time_range(_states(spark, sf, "mv_sensor_hourly"), "reading_hour", *RANGE))


def q_threshold_band(spark: SparkSession, sf: str) -> DataFrame:
    return sensor_bands(panel_sensor(_states(spark, sf, "mv_sensor_hourly")))


def q_anomaly_band(spark: SparkSession, sf: str) -> DataFrame:
    return anomaly_band(panel_anomaly(_states(spark, sf, "mv_anomaly_daily")))


# ---- whole pipeline -------------------------------------------------------------------------------

TABLES = ("dim_machines", "dim_sensors", "fact_production_orders", "fact_sensor_readings")
SPECS = [TableSpec(t) for t in TABLES]


def q_pipeline_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    register(spark, sf, *TABLES)
    run_pipeline(spark, SPECS, layout)
    return panel_machine(read_states(spark, layout, "mv_machine_daily"))


def q_pipeline_replay(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    register(spark, sf, *TABLES)
    run_pipeline(spark, SPECS, layout)
    run_pipeline(spark, SPECS, layout)
    return panel_anomaly(read_states(spark, layout, "mv_anomaly_daily"))


def _changed_source(spark: SparkSession, sf: str) -> Layout:
    """Run over the orders, change the source, run again."""
    layout = Layout(work_dir(spark))
    register(spark, sf, "orders_changed")
    name = "fact_production_orders"
    run_pipeline(spark, [TableSpec(name, query=f"select * from {name}")], layout)
    run_pipeline(spark, [TableSpec(name, query="select * from orders_changed")], layout)
    return layout


def q_pipeline_incremental(spark: SparkSession, sf: str) -> DataFrame:
    layout = _changed_source(spark, sf)
    return panel_production(read_states(spark, layout, "mv_production_daily"))


def q_pipeline_torn_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch is torn when the first is transformed, and landed whole by the repeated extract."""
    layout = Layout(work_dir(spark))
    register(spark, sf, "orders_changed")
    name = "fact_production_orders"
    run_extract(spark, TableSpec(name, query=f"select * from {name}"), layout)
    torn = view(spark, sf, "order_changes").filter("target_qty > 200")
    torn.write.parquet(numbered(layout.landing(name), "seq", 1))
    run_transform(spark, name, layout)
    run_extract(spark, TableSpec(name, query="select * from orders_changed"), layout)
    run_transform(spark, name, layout)
    return as_of(spark, layout.table(name))


def q_pipeline_load_stopped(spark: SparkSession, sf: str) -> DataFrame:
    """A load stops between two versions and again while it repeats; readers never lose the first."""
    layout = Layout(work_dir(spark))
    name = "fact_production_orders"
    for v, rows in enumerate((name, "order_changes")):
        append_version(view(spark, sf, rows), layout.table(name), v)
    _loaded(spark, sf, layout, 0)
    torn = view(spark, sf, "order_changes").filter("target_qty > 200")
    torn.write.parquet(numbered(layout.warehouse(name), "_delta_version", 1))
    run_load(spark, name, layout)
    return as_of(spark, layout.warehouse(name))


def q_pipeline_latest_table(spark: SparkSession, sf: str) -> DataFrame:
    return latest_table(spark, _changed_source(spark, sf), "fact_production_orders")


class Stopped(Exception):
    """Ends a stream after it has written and before its checkpoint moves."""


def _stop(*_: int) -> None:
    raise Stopped


def _stopped(run: Callable[[], None]) -> None:
    try:
        run()
    except StreamingQueryException as e:
        if "Stopped" not in str(e):
            raise


def _streamed_log(spark: SparkSession, sf: str) -> Layout:
    """Two landed batches, one of them torn at first; the stream stops after it has written each."""
    layout, name = Layout(work_dir(spark)), "fact_production_orders"
    landing = layout.landing(name)
    land(view(spark, sf, name), landing, 0)
    changes = view(spark, sf, "order_changes")
    changes.filter("target_qty > 200").write.parquet(numbered(landing, "seq", 1))
    _stopped(lambda: stream_transform(spark, name, layout, written=_stop))
    stream_transform(spark, name, layout)
    land(changes, landing, 1)
    _stopped(lambda: stream_transform(spark, name, layout, written=_stop))
    stream_transform(spark, name, layout)
    return layout


def q_stream_transform(spark: SparkSession, sf: str) -> DataFrame:
    return as_of(spark, _streamed_log(spark, sf).table("fact_production_orders"))


def q_stream_load(spark: SparkSession, sf: str) -> DataFrame:
    """Versions loaded one by one, with a stop after the first; the marts count each version once."""
    layout, name = _streamed_log(spark, sf), "fact_production_orders"
    _stopped(lambda: stream_load(spark, name, layout, most=1, loaded=_stop))
    stream_load(spark, name, layout, most=1)
    return panel_production(read_states(spark, layout, "mv_production_daily"))


def q_stream_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    layout = Layout(work_dir(spark))
    register(spark, sf, *TABLES)
    for spec in SPECS:
        run_extract(spark, spec, layout)
        stream_transform(spark, spec.name, layout)
        stream_load(spark, spec.name, layout)
    return panel_machine(read_states(spark, layout, "mv_machine_daily"))


def entry(spark: SparkSession) -> DataFrame:
    """Daily anomaly rate, from readings to an ordered panel."""
    return q_panel_anomaly(spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    found = table_queries()
    if llm is not None:
        found |= {**llm.queries(), "pipeline": corpus_pipeline.run}
    return found


def table_queries() -> dict[str, Query]:
    """The queries on factory tables."""
    return {
        "scan_full": q_scan_full,
        "scan_query": q_scan_query,
        "scan_since_ts": q_scan_since_ts,
        "scan_since_ts_key": q_scan_since_ts_key,
        "watermark_advance": q_watermark_advance,
        "scan_landing": q_scan_landing,
        "scan_new_files": q_scan_new_files,
        "cast_time_columns": q_cast_time_columns,
        "to_naive_utc": q_to_naive_utc,
        "drop_exact_duplicates": q_drop_exact_duplicates,
        "deterministic_sort": q_deterministic_sort,
        "concat_strict": q_concat_strict,
        "append_version": q_append_version,
        "current_version": q_current_version,
        "versions": q_versions,
        "added_since": q_added_since,
        "as_of": q_as_of,
        "as_of_time": q_as_of_time,
        "as_of_unmarked": q_as_of_unmarked,
        "latest_by_key": q_latest_by_key,
        "latest_by_key_ties": q_latest_by_key_ties,
        "conform": q_conform,
        "mart_production_daily": _mart("mv_production_daily", "orders_log"),
        "mart_machine_daily": _mart("mv_machine_daily", "orders_log"),
        "mart_sensor_hourly": _mart("mv_sensor_hourly", "fact_sensor_readings"),
        "mart_anomaly_daily": _mart("mv_anomaly_daily", "fact_sensor_readings"),
        "mart_incremental_refresh": q_mart_incremental_refresh,
        "mart_backfill": q_mart_backfill,
        "mart_latest": q_mart_latest,
        "mart_folded": q_mart_folded,
        "mart_added_later": q_mart_added_later,
        "mart_latest_after_load": q_mart_latest_after_load,
        "mart_latest_increments": q_mart_latest_increments,
        "mart_latest_folded": q_mart_latest_folded,
        "panel_time_range_pruned": q_panel_time_range_pruned,
        "mart_rebuild": q_mart_rebuild,
        "panel_production": q_panel_production,
        "panel_machine": q_panel_machine,
        "panel_machine_one": q_panel_machine_one,
        "panel_sensor": q_panel_sensor,
        "panel_sensor_one": q_panel_sensor_one,
        "panel_anomaly": q_panel_anomaly,
        "picker_machine": q_picker_machine,
        "picker_sensor": q_picker_sensor,
        "panel_time_range": q_panel_time_range,
        "threshold_band": q_threshold_band,
        "anomaly_band": q_anomaly_band,
        "pipeline_end_to_end": q_pipeline_end_to_end,
        "pipeline_replay": q_pipeline_replay,
        "pipeline_incremental": q_pipeline_incremental,
        "pipeline_latest_table": q_pipeline_latest_table,
        "pipeline_torn_landing": q_pipeline_torn_landing,
        "pipeline_load_stopped": q_pipeline_load_stopped,
        "stream_transform": q_stream_transform,
        "stream_load": q_stream_load,
        "stream_end_to_end": q_stream_end_to_end,
    }


# ---- checks ---------------------------------------------------------------------------------------

LATEST_ORDERS = """select * exclude (rn) from (
 select *, row_number() over (partition by order_id order by _delta_version desc,
  updated_at desc nulls last) as rn from orders_log) where rn = 1"""

LATEST_LINES = """select * exclude (rn) from (
 select *, row_number() over (partition by l_orderkey order by l_linenumber desc,
  l_shipdate desc nulls last, l_partkey desc nulls last, l_suppkey desc nulls last,
  l_quantity desc nulls last, l_extendedprice desc nulls last, l_discount desc nulls last,
  l_tax desc nulls last, l_returnflag desc nulls last, l_linestatus desc nulls last) as rn
 from lineitem) where rn = 1"""


def _production(rows: str) -> str:
    return f"""select cast(start_time as date) as order_date, count(*) as order_count,
 cast(sum(target_qty) as bigint) as target_total, cast(sum(actual_qty) as bigint) as actual_total,
 cast(sum(cast(target_qty as bigint) - cast(actual_qty as bigint)) as bigint) as gap_total
from {rows} where start_time is not null group by 1"""


MACHINE_DAILY = """select machine_id, cast(start_time as date) as order_date,
 count(*) as order_count, cast(sum(target_qty) as bigint) as target_total,
 cast(sum(actual_qty) as bigint) as actual_total
from orders_log where machine_id is not null and start_time is not null group by 1, 2"""

def _sensor_hourly(rows: str = "fact_sensor_readings") -> str:
    return f"""select sensor_id, date_trunc('hour', reading_timestamp) as reading_hour,
 cast(sum(reading_value) as double) / count(reading_value) as avg_val,
 max(reading_value) as max_val, min(reading_value) as min_val, count(*) as readings,
 cast(sum(cast(is_anomaly as int)) as bigint) as anomaly_count
from {rows} where sensor_id is not null group by 1, 2"""


LATEST_READINGS = """select * exclude (rn) from (
 select *, row_number() over (partition by reading_id order by _delta_version desc) as rn
 from readings_log) where rn = 1"""

ANOMALY_DAILY = """select cast(reading_timestamp as date) as reading_date,
 cast(sum(cast(is_anomaly as int)) as bigint) as anomaly_count, count(*) as total_readings
from fact_sensor_readings group by 1"""


def _panel_production(rows: str) -> str:
    return f"""select order_date, order_count as orders, target_total as target_qty,
 actual_total as actual_qty, gap_total as gap from ({_production(rows)}) order by order_date"""


def _panel_machine(where: str = "") -> str:
    return f"""select machine_id, orders, target_qty, actual_qty,
 round_even(cast(actual_qty as double) / nullif(target_qty, 0) * 100, 1) as utilization_pct
from (select machine_id, count(*) as orders, cast(sum(target_qty) as bigint) as target_qty,
  cast(sum(actual_qty) as bigint) as actual_qty from fact_production_orders
  where machine_id is not null and start_time is not null {where} group by 1)
order by actual_qty desc nulls last, machine_id"""


def _panel_sensor(where: str = "", rows: str = "fact_sensor_readings") -> str:
    return f"""select reading_hour, sensor_id, avg_val as avg_value, max_val as max_value,
 min_val as min_value from ({_sensor_hourly(rows)}) {where} order by reading_hour, sensor_id"""


PANEL_ANOMALY = f"""select reading_date, anomaly_count as anomalies, total_readings,
 round_even(cast(anomaly_count as double) / nullif(total_readings, 0) * 100, 2) as anomaly_rate_pct
from ({ANOMALY_DAILY}) order by reading_date"""


def _band(c: str) -> str:
    return f"case when {c} > 95 then 'red' when {c} > 90 then 'orange' else 'green' end as {c}_band"


def oracle_sql() -> dict[str, str]:
    log_rows = "select * exclude (_delta_version) from orders_log"
    since = f"select * from orders where o_orderdate > timestamp '{MARK}'"
    in_range = f"where reading_hour between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'"
    texts = {
        "scan_full": "select * from fact_production_orders",
        "scan_query": QUERY_TEXT,
        "scan_since_ts": since,
        "scan_since_ts_key": f"{since} or (o_orderdate = timestamp '{MARK}' and o_orderkey > {MARK_KEY})",
        "watermark_advance": """select updated_at as last_value, max(order_id) as last_unique
 from fact_production_orders
 where updated_at = (select max(updated_at) from fact_production_orders) group by 1""",
        "scan_landing": log_rows,
        "scan_new_files": "select * from order_changes",
        "cast_time_columns": """select * exclude (reading_timestamp, updated_at),
 case when reading_id % 2 = 0 then reading_timestamp - interval '2' hour else reading_timestamp
  end as Reading_Timestamp,
 cast(cast(updated_at as date) as timestamp) as updated_at from fact_sensor_readings""",
        "to_naive_utc": """select * exclude (reading_timestamp),
 reading_timestamp - interval '2' hour as reading_timestamp from fact_sensor_readings""",
        "drop_exact_duplicates": "select distinct * from lineitem",
        "deterministic_sort": "select * from fact_production_orders",
        "concat_strict": log_rows,
        "append_version": "select * from orders_log",
        "current_version": """select _delta_version as current_version, count(*) as rows_added
 from orders_log where _delta_version = (select max(_delta_version) from orders_log) group by 1""",
        "versions": "select distinct _delta_version from orders_log",
        "added_since": "select * from orders_log where _delta_version > 0",
        "as_of": "select * from orders_log where _delta_version <= 0",
        "as_of_time": "select * from orders_log where _delta_version <= 0",
        "as_of_unmarked": "select * from orders_log where _delta_version = 1",
        "latest_by_key": LATEST_ORDERS,
        "latest_by_key_ties": LATEST_LINES,
        "conform": "select *, cast(3 as bigint) as _delta_version from fact_sensor_readings",
        "mart_production_daily": _production("orders_log"),
        "mart_machine_daily": MACHINE_DAILY,
        "mart_sensor_hourly": _sensor_hourly(),
        "mart_anomaly_daily": ANOMALY_DAILY,
        "mart_incremental_refresh": MACHINE_DAILY,
        "mart_backfill": _production("orders_log"),
        "mart_latest": _production(f"({LATEST_ORDERS})"),
        "mart_folded": MACHINE_DAILY,
        "mart_added_later": _production("orders_log"),
        "mart_latest_after_load": _production(f"({LATEST_ORDERS})"),
        "mart_rebuild": MACHINE_DAILY,
        "panel_production": _panel_production("fact_production_orders"),
        "panel_machine": _panel_machine(),
        "panel_machine_one": _panel_machine(f"and machine_id = '{MACHINE}'"),
        "panel_sensor": _panel_sensor(),
        "panel_sensor_one": _panel_sensor(f"where sensor_id = '{SENSOR}'"),
        "panel_anomaly": PANEL_ANOMALY,
        "picker_machine": """select distinct machine_id from fact_production_orders
 where machine_id is not null and start_time is not null""",
        "picker_sensor": "select distinct sensor_id from fact_sensor_readings where sensor_id is not null",
        "panel_time_range": _panel_sensor(in_range),
        "panel_time_range_pruned": _panel_sensor(in_range, "readings_log"),
        "mart_latest_increments": _sensor_hourly(f"({LATEST_READINGS})"),
        "mart_latest_folded": _sensor_hourly(f"({LATEST_READINGS})"),
        "threshold_band": f"""select reading_hour, sensor_id,
 {", ".join(_band(c) for c in ("avg_value", "max_value", "min_value"))} from ({_panel_sensor()})""",
        "anomaly_band": f"""select reading_date, anomaly_rate_pct,
 case when anomaly_rate_pct > 10 then 'red' when anomaly_rate_pct > 5 then 'orange' else 'green' end as rate_band
 from ({PANEL_ANOMALY})""",
        "pipeline_end_to_end": _panel_machine(),
        "pipeline_replay": PANEL_ANOMALY,
        "pipeline_incremental": _panel_production("orders_log"),
        "pipeline_latest_table": LATEST_ORDERS,
        "pipeline_torn_landing": "select * from orders_log",
        "pipeline_load_stopped": "select * from orders_log",
        "stream_transform": "select * from orders_log",
        "stream_load": _panel_production("orders_log"),
        "stream_end_to_end": _panel_machine(),
    }
    checks = {name: check_sql(text) for name, text in texts.items()}
    if llm is not None:
        checks |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            checks["pipeline"] = corpus_pipeline.ORACLE_SQL
    return checks
