"""Marts of newest rows that follow their table by retraction, and stored states pruned by month."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import millrace.plans.marts as marts
from millrace.operators import aggregate, latest_by_key
from millrace.plans import (
    MARTS,
    build_mart,
    conform,
    fold_mart,
    panel_sensor,
    read_mart,
    read_states,
    refresh_mart,
    refresh_marts,
    time_range,
)
from millrace.plans.newest import replaced_rows
from millrace.sources import append_version

NAME = "fact_sensor_readings"
SENSORS, ANOMALIES = "mv_sensor_hourly", "mv_anomaly_daily"


def readings(spark, rows):
    """``(id, sensor, value, anomaly, hour)`` as readings of May and June."""
    made = [(i, s, Decimal(v).quantize(Decimal("0.0001")), a, datetime(2026, 5, 30) + timedelta(hours=h)) for i, s, v, a, h in rows]
    ddl = "reading_id long, sensor_id string, reading_value decimal(10,4), is_anomaly boolean, reading_timestamp timestamp_ntz"
    df = spark.createDataFrame(made, ddl)
    return df.select("*", *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("created_at", "updated_at")])


def load(spark, layout, v, rows):
    df = readings(spark, rows).withColumn("_delta_version", F.lit(v).cast("long"))
    append_version(conform(df, NAME), layout.warehouse(NAME), v)
    return df


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(loads, name):
    log = loads[0]
    for df in loads[1:]:
        log = log.unionByName(df)
    return tuples(aggregate(latest_by_key(log, ["reading_id"]), MARTS[name]))


def check(spark, layout, loads):
    for name in (SENSORS, ANOMALIES):
        assert tuples(read_mart(spark, layout, name, "latest")) == expected(loads, name)


@pytest.mark.parametrize("seed, buckets", [(1, 1), (2, 7)])
def test_random_loads_equal_the_full_build(spark, layout, monkeypatch, seed, buckets):
    """Values move between groups, leave them, become NULL and were extremes; some groups disappear."""
    monkeypatch.setattr("millrace.plans.newest.BUCKET_ROWS", 40 // buckets)
    rng = random.Random(seed)
    loads = []
    for v in range(4):
        ids = rng.sample(range(40), 40 if v == 0 else 9)
        rows = [
            (i, rng.choice(["S1", "S2", None]), rng.randrange(-3, 4), rng.choice([True, False, None]), rng.randrange(0, 72, 24))
            for i in ids
        ]
        loads.append(load(spark, layout, v, rows))
        for name in (SENSORS, ANOMALIES):
            refresh_mart(spark, layout, name, "latest")
        check(spark, layout, loads)
    for name in (SENSORS, ANOMALIES):
        fold_mart(spark, layout, name, "latest")
    check(spark, layout, loads)
    loads.append(load(spark, layout, 4, [(0, "S9", 5, None, 0), (99, None, 1, True, 24)]))
    refresh_marts(spark, layout, NAME)
    check(spark, layout, loads)


def test_extreme_and_null_are_taken_back(spark, layout):
    loads = [load(spark, layout, 0, [(1, "S", 9, True, 0), (2, "S", 5, None, 0), (3, "S", 7, None, 0), (4, "T", 1, True, 0)])]
    build_mart(spark, layout, SENSORS, "latest")
    loads.append(load(spark, layout, 1, [(1, "S", 6, None, 0), (4, None, 1, True, 0)]))
    refresh_mart(spark, layout, SENSORS, "latest")
    row = read_mart(spark, layout, SENSORS, "latest").collect()
    assert [(r.sensor_id, r.max_val, r.min_val, r.readings, r.anomaly_count) for r in row] == [("S", 7, 5, 3, None)]
    assert tuples(read_mart(spark, layout, SENSORS, "latest")) == expected(loads, SENSORS)


def test_stopped_refresh_is_finished_first(spark, layout, monkeypatch):
    """The index part is written, its states are not, and another version arrives before the retry."""
    loads = [load(spark, layout, 0, [(i, "S", i, True, 0) for i in range(6)])]
    build_mart(spark, layout, SENSORS, "latest")
    loads.append(load(spark, layout, 1, [(5, "S", 1, False, 0)]))
    write = marts._write_part

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(marts, "_write_part", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        refresh_mart(spark, layout, SENSORS, "latest")
    assert tuples(read_mart(spark, layout, SENSORS, "latest")) == expected(loads[:1], SENSORS)
    monkeypatch.setattr(marts, "_write_part", write)
    loads.append(load(spark, layout, 2, [(4, "T", 1, None, 0), (5, "T", 8, None, 0)]))
    for _ in range(2):
        refresh_mart(spark, layout, SENSORS, "latest")
        assert tuples(read_mart(spark, layout, SENSORS, "latest")) == expected(loads, SENSORS)


def scan_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_cost_follows_the_touched_keys(spark, layout, monkeypatch):
    """Only the folders of the new keys are read, and only rows of these keys leave the scan's tasks."""
    monkeypatch.setattr("millrace.plans.newest.BUCKET_ROWS", 10)
    load(spark, layout, 0, [(i, "S", 1, None, 0) for i in range(200)])
    build_mart(spark, layout, ANOMALIES, "latest")
    load(spark, layout, 1, [(3, "S", 1, True, 0)])
    refresh_mart(spark, layout, ANOMALIES, "latest")
    index = marts.index_path(layout.mart(ANOMALIES, "latest", 0))
    _, former = replaced_rows(spark, MARTS[ANOMALIES], index, 1)
    plan = scan_plan(former)
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "is_anomaly" in line)
    assert "bucket" in scan.split("PartitionFilters: [")[1].split("]")[0] and "LeftSemi" in plan
    assert former.count() == 1 and spark.read.parquet(f"{index}/part=0").select("bucket").distinct().count() > 10


def test_panel_reads_the_months_of_its_range(spark, layout):
    rows = [(i, f"S{i % 3}", i, None, h) for i, h in enumerate(range(0, 24 * 90, 7))]
    load(spark, layout, 0, rows)
    refresh_mart(spark, layout, SENSORS)
    states = read_states(spark, layout, SENSORS)
    panel = panel_sensor(time_range(states, "reading_hour", "2026-06-02 00:00:00", "2026-06-03 12:00:00"))
    plan = scan_plan(panel)
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "_month" in scan.split("PartitionFilters: [")[1].split("]")[0] and "2026-06" in scan
    read = time_range(states, "reading_hour", "2026-06-02 00:00:00", "2026-06-03 12:00:00")
    hours = {r.reading_hour for r in panel.collect()}
    assert min(hours) >= datetime(2026, 6, 2) and max(hours) <= datetime(2026, 6, 3, 12) and read.count() == len(panel.collect())
    everything = panel_sensor(time_range(states, "reading_hour", "2026-01-01 00:00:00", "2027-01-01 00:00:00"))
    assert everything.count() == panel_sensor(states).count() == len(rows)
