"""The supplied tables seen as factory tables.

One SELECT per table, valid in Spark and in DuckDB, so a query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DIM_MACHINES = """
select 'MCH-'||lpad(cast(s_suppkey as string),6,'0') as machine_id, s_name as machine_name,
 'TYPE-'||cast(s_nationkey as string) as machine_type,
 'LOC-'||cast(s_nationkey % 5 as string) as location,
 case when s_acctbal < 0 then null else 'active' end as status,
 {ts} '2024-01-01 00:00:00' as created_at, {ts} '2024-01-01 00:00:00' as updated_at
from supplier"""

DIM_SENSORS = """
select distinct
 'MCH-'||lpad(cast(user_id % 10 as string),6,'0')||'-S'||cast(user_id as string) as sensor_id,
 case when user_id % 11 = 0 then null
  else 'MCH-'||lpad(cast(user_id % 10 as string),6,'0') end as machine_id,
 case when user_id % 2 = 0 then 'temperature' else 'vibration' end as sensor_type,
 case when user_id % 2 = 0 then 'C' else 'mm/s' end as measurement_unit,
 {ts} '2024-01-01 00:00:00' as created_at, {ts} '2024-01-01 00:00:00' as updated_at
from events"""

READINGS = """
select event_id as reading_id,
 case when event_id % 19 = 0 then null
  else 'MCH-'||lpad(cast(user_id % 10 as string),6,'0')||'-S'||cast(user_id as string)
 end as sensor_id,
 cast(value as decimal(10,4)) as reading_value,
 case when event_id % 23 = 0 then null else event_type = 'error' end as is_anomaly,
 ts as reading_timestamp, ts as created_at, ts as updated_at
from events"""

ORDERS = """
select 'ORD-'||lpad(cast(o_orderkey as string),10,'0') as order_id,
 case when o_orderkey % 17 = 0 then null
  else 'MCH-'||lpad(cast(o_custkey % 100 as string),6,'0') end as machine_id,
 'SKU-'||cast(o_custkey % 50 as string) as product_sku,
 cast(floor(o_totalprice / 1000) as int) as target_qty,
 case when o_orderstatus = 'P' then null
  else cast(floor(o_totalprice / 1000) - o_orderkey % 7 + 2 as int) end as actual_qty,
 o_orderstatus as status,
 case when o_orderkey % 13 = 0 then null else o_orderdate end as start_time,
 case when o_orderstatus = 'F' then o_orderdate + interval '1' day else null end as end_time,
 o_orderdate as created_at, o_orderdate as updated_at
from orders"""

# Later changes of the open orders: one more piece made, and a time past every first one.
ORDER_CHANGES = """
select order_id, machine_id, product_sku, target_qty, actual_qty + 1 as actual_qty, status,
 start_time, end_time, created_at, updated_at + interval '10' year as updated_at
from fact_production_orders where status = 'O'"""

# The source table after those changes.
ORDERS_CHANGED = """
select order_id, machine_id, product_sku, target_qty,
 case when status = 'O' then actual_qty + 1 else actual_qty end as actual_qty, status,
 start_time, end_time, created_at,
 case when status = 'O' then updated_at + interval '10' year else updated_at end as updated_at
from fact_production_orders"""

ORDERS_LOG = """
select *, cast(0 as bigint) as _delta_version from fact_production_orders
union all
select *, cast(1 as bigint) as _delta_version from order_changes"""

# Two later loads of readings: corrected values, some of another hour, then readings that lose their
# sensor or their value, and new ones.
READING_FIXES = """
select reading_id, sensor_id, cast(90 - reading_value as decimal(10,4)) as reading_value,
 case when reading_id % 4 = 0 then null else reading_id % 8 = 1 end as is_anomaly,
 reading_timestamp + (case when reading_id % 2 = 0 then interval '1' hour else interval '0' hour end) as reading_timestamp,
 created_at, updated_at + interval '1' year as updated_at
from fact_sensor_readings where reading_id % 3 = 0"""

READING_DROPS = """
select reading_id, case when reading_id % 2 = 0 then null else sensor_id end as sensor_id, reading_value, is_anomaly,
 reading_timestamp, created_at, updated_at + interval '2' year as updated_at
from fact_sensor_readings where reading_id % 5 = 0
union all
select reading_id + 100000000, sensor_id, cast(reading_value + 1 as decimal(10,4)) as reading_value, null as is_anomaly,
 reading_timestamp, created_at, updated_at + interval '2' year as updated_at
from fact_sensor_readings where reading_id % 7 = 0"""

READINGS_LOG = """
select *, cast(0 as bigint) as _delta_version from fact_sensor_readings
union all
select *, cast(1 as bigint) as _delta_version from reading_fixes
union all
select *, cast(2 as bigint) as _delta_version from reading_drops"""

VIEWS = {
    "dim_machines": DIM_MACHINES,
    "dim_sensors": DIM_SENSORS,
    "fact_sensor_readings": READINGS,
    "fact_production_orders": ORDERS,
    "order_changes": ORDER_CHANGES,
    "orders_changed": ORDERS_CHANGED,
    "orders_log": ORDERS_LOG,
    "reading_fixes": READING_FIXES,
    "reading_drops": READING_DROPS,
    "readings_log": READINGS_LOG,
}
READS = {
    "dim_machines": ("supplier",),
    "dim_sensors": ("events",),
    "fact_sensor_readings": ("events",),
    "fact_production_orders": ("orders",),
    "order_changes": ("fact_production_orders",),
    "orders_changed": ("fact_production_orders",),
    "orders_log": ("fact_production_orders", "order_changes"),
    "reading_fixes": ("fact_sensor_readings",),
    "reading_drops": ("fact_sensor_readings",),
    "readings_log": ("fact_sensor_readings", "reading_fixes", "reading_drops"),
}


def register(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Create temporary views of the named tables and of those they read."""
    for name in names:
        if name in VIEWS:
            register(spark, sf_dir, *READS[name])
            spark.sql(VIEWS[name].format(ts="timestamp_ntz")).createOrReplaceTempView(name)
        else:
            spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register(spark, sf_dir, name)
    return spark.table(name)


def check_sql(body: str) -> str:
    """``body`` with every factory table in front of it, for DuckDB."""
    views = ",\n".join(f"{n} as ({t.format(ts='timestamp')})" for n, t in VIEWS.items())
    return f"with {views}\n{body}"
