"""Marts and panels on hand-written rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import aggregate, latest_by_key, merge, partial
from millrace.plans import (
    CONTRACTS,
    MARTS,
    Contract,
    build_mart,
    conform,
    fold_mart,
    panel_anomaly,
    panel_machine,
    panel_production,
    panel_sensor,
    picker,
    read_mart,
    read_states,
    refresh_mart,
    refresh_marts,
    time_range,
)
from millrace.sources import append_version

D1, D2 = date(2026, 5, 1), date(2026, 5, 2)
LATE = datetime(2026, 5, 1, 23, 59, 59, 999999)
LOG = [
    ("O1", "M1", 100, 90, LATE, 0),
    ("O2", "M1", 50, None, datetime(2026, 5, 1, 8), 0),
    ("O3", None, 10, 12, datetime(2026, 5, 2), 0),
    ("O4", "M2", 0, 0, datetime(2026, 5, 2, 10), 0),
    ("O5", "M2", 20, 20, None, 0),
    ("O1", "M1", 100, 95, LATE, 1),
]
READINGS = [
    (1, "S1", Decimal("90.0000"), True, datetime(2026, 5, 1, 10, 59, 59, 999999)),
    (2, "S1", Decimal("95.0000"), False, datetime(2026, 5, 1, 10)),
    (3, "S1", Decimal("95.0001"), None, datetime(2026, 5, 1, 11)),
    (4, None, Decimal("10.0000"), True, datetime(2026, 5, 1, 11, 30)),
    (5, "S2", Decimal("1.0000"), None, datetime(2026, 5, 1, 10, 5)),
]


def fill(spark, rows, ddl, name):
    df = spark.createDataFrame(rows, ddl)
    for f in CONTRACTS[name].schema.fields:
        if f.name not in df.columns:
            value = F.lit("x") if f.name == "product_sku" else F.lit(None)
            df = df.withColumn(f.name, value.cast(f.dataType))
    return df


@pytest.fixture
def log(spark):
    ddl = (
        "order_id string, machine_id string, target_qty int, actual_qty int,"
        " start_time timestamp_ntz, _delta_version long"
    )
    return fill(spark, LOG, ddl, "fact_production_orders")


@pytest.fixture
def readings(spark):
    ddl = (
        "reading_id long, sensor_id string, reading_value decimal(10,4), is_anomaly boolean,"
        " reading_timestamp timestamp_ntz"
    )
    df = fill(spark, READINGS, ddl, "fact_sensor_readings")
    return df.withColumn("_delta_version", F.lit(0).cast("long"))


def tuples(df):
    return [tuple(r) for r in df.collect()]


def states(df, name):
    return partial(df, MARTS[name])


def test_production_counts_every_version(log):
    panel = panel_production(states(log, "mv_production_daily"))
    assert tuples(panel) == [(D1, 3, 250, 185, 15), (D2, 2, 10, 12, -2)]


def test_production_of_newest_rows(log):
    newest = latest_by_key(log, ["order_id"])
    panel = panel_production(states(newest, "mv_production_daily"))
    assert tuples(panel) == [(D1, 2, 150, 95, 5), (D2, 2, 10, 12, -2)]


def test_machine_rollup_and_zero_target(log):
    s = states(log, "mv_machine_daily")
    assert tuples(panel_machine(s)) == [("M1", 3, 250, 185, 74.0), ("M2", 1, 0, 0, None)]
    assert tuples(panel_machine(s, "M1")) == [("M1", 3, 250, 185, 74.0)]
    newest = states(latest_by_key(log, ["order_id"]), "mv_machine_daily")
    assert tuples(panel_machine(newest, "M1")) == [("M1", 2, 150, 95, 63.3)]
    assert sorted(tuples(picker(s, "machine_id"))) == [("M1",), ("M2",)]


def test_sensor_hourly(readings):
    mart = aggregate(readings, MARTS["mv_sensor_hourly"]).orderBy("sensor_id", "reading_hour")
    ten, eleven = datetime(2026, 5, 1, 10), datetime(2026, 5, 1, 11)
    assert tuples(mart) == [
        ("S1", ten, 92.5, Decimal("95.0000"), Decimal("90.0000"), 2, 1),
        ("S1", eleven, 95.0001, Decimal("95.0001"), Decimal("95.0001"), 1, None),
        ("S2", ten, 1.0, Decimal("1.0000"), Decimal("1.0000"), 1, None),
    ]
    s = states(readings, "mv_sensor_hourly")
    assert [(r.reading_hour, r.sensor_id) for r in panel_sensor(s).collect()] == [
        (ten, "S1"),
        (ten, "S2"),
        (eleven, "S1"),
    ]
    assert [r.reading_hour for r in panel_sensor(s, "S1").collect()] == [ten, eleven]
    late = time_range(s, "reading_hour", "2026-05-01 11:00:00", "2026-05-02 00:00:00")
    assert [r.sensor_id for r in panel_sensor(late).collect()] == ["S1"]


def test_anomaly_panel_counts_readings_without_sensor(readings):
    assert tuples(panel_anomaly(states(readings, "mv_anomaly_daily"))) == [(D1, 2, 5, 40.0)]


def test_all_null_flags_give_null(readings):
    quiet = states(readings.filter("is_anomaly is null"), "mv_anomaly_daily")
    assert tuples(panel_anomaly(quiet)) == [(D1, None, 2, None)]


def test_gap_does_not_overflow(spark):
    big = fill(
        spark,
        [("O1", "M1", 2**31 - 1, -(2**31), LATE, 0)],
        "order_id string, machine_id string, target_qty int, actual_qty int,"
        " start_time timestamp_ntz, _delta_version long",
        "fact_production_orders",
    )
    assert panel_production(states(big, "mv_production_daily")).first().gap == 2**32 - 1


def load(log, layout, v):
    path = layout.warehouse("fact_production_orders")
    append_version(conform(log.filter(F.col("_delta_version") == v), "fact_production_orders"), path, v)


def test_refresh_by_version_equals_one_build_and_survives_replay(spark, log, layout):
    for v in (0, 1):
        load(log, layout, v)
        for name in ("mv_production_daily", "mv_machine_daily"):
            refresh_mart(spark, layout, name)
    refresh_mart(spark, layout, "mv_production_daily")
    for name in ("mv_production_daily", "mv_machine_daily"):
        stored = read_mart(spark, layout, name)
        assert stored.dtypes == aggregate(log, MARTS[name]).dtypes
        assert sorted(tuples(stored)) == sorted(tuples(aggregate(log, MARTS[name])))
    assert read_states(spark, layout, "mv_production_daily").count() == 3
    fold_mart(spark, layout, "mv_production_daily")
    assert read_states(spark, layout, "mv_production_daily").count() == 2
    assert sorted(tuples(read_mart(spark, layout, "mv_production_daily"))) == sorted(
        tuples(aggregate(log, MARTS["mv_production_daily"]))
    )
    refresh_mart(spark, layout, "mv_production_daily")
    assert read_states(spark, layout, "mv_production_daily").count() == 2


def test_version_without_mart_rows(spark, log, layout):
    path = layout.warehouse("fact_production_orders")
    rows = log.filter("machine_id is null").withColumn("_delta_version", F.lit(0).cast("long"))
    append_version(conform(rows, "fact_production_orders"), path, 0)
    refresh_mart(spark, layout, "mv_machine_daily")
    assert read_mart(spark, layout, "mv_machine_daily").count() == 0
    load(log, layout, 1)
    refresh_mart(spark, layout, "mv_machine_daily")
    assert tuples(read_mart(spark, layout, "mv_machine_daily")) == [("M1", D1, 1, 100, 95)]


def test_several_versions_in_one_refresh(spark, log, layout):
    load(log, layout, 0)
    load(log, layout, 1)
    for _ in range(2):
        refresh_mart(spark, layout, "mv_production_daily")
    assert read_states(spark, layout, "mv_production_daily").count() == 2
    assert sorted(tuples(read_mart(spark, layout, "mv_production_daily"))) == sorted(
        tuples(aggregate(log, MARTS["mv_production_daily"]))
    )


def test_torn_part_and_torn_build_are_not_read(spark, log, layout):
    load(log, layout, 0)
    refresh_mart(spark, layout, "mv_production_daily")
    before = tuples(read_mart(spark, layout, "mv_production_daily"))
    part = read_states(spark, layout, "mv_production_daily")
    for build in (0, 1):
        part.write.parquet(f"{layout.mart('mv_production_daily', 'append', build)}/part=1")
    assert tuples(read_mart(spark, layout, "mv_production_daily")) == before
    load(log, layout, 1)
    refresh_mart(spark, layout, "mv_production_daily")
    assert sorted(tuples(read_mart(spark, layout, "mv_production_daily"))) == sorted(
        tuples(aggregate(log, MARTS["mv_production_daily"]))
    )


def test_latest_mart_follows_the_loads(spark, log, layout):
    load(log, layout, 0)
    build_mart(spark, layout, "mv_production_daily", mode="latest")
    load(log, layout, 1)
    refresh_marts(spark, layout, "fact_production_orders")
    newest = latest_by_key(log, ["order_id"])
    assert sorted(tuples(read_mart(spark, layout, "mv_production_daily", "latest"))) == sorted(
        tuples(aggregate(newest, MARTS["mv_production_daily"]))
    )


def test_build_modes_and_replace(spark, log, layout):
    load(log, layout, 0)
    build_mart(spark, layout, "mv_production_daily")
    with pytest.raises(FileExistsError):
        build_mart(spark, layout, "mv_production_daily")
    load(log, layout, 1)
    build_mart(spark, layout, "mv_production_daily", replace=True)
    build_mart(spark, layout, "mv_production_daily", mode="latest")
    counts = [
        sum(r.order_count for r in read_mart(spark, layout, "mv_production_daily", mode).collect())
        for mode in ("append", "latest")
    ]
    assert counts == [5, 4]
    with pytest.raises(ValueError, match="mode"):
        build_mart(spark, layout, "mv_production_daily", mode="newest")


def test_conform_checks(spark, readings):
    name = "fact_sensor_readings"
    out = conform(readings.select(*reversed(readings.columns)), name)
    assert out.schema == CONTRACTS[name].schema
    with pytest.raises(ValueError, match="missing"):
        conform(readings.drop("is_anomaly"), name)
    with pytest.raises(ValueError, match="unknown"):
        conform(readings.withColumn("extra", F.lit(1)), name)
    with pytest.raises(PySparkException, match="NULL in fact_sensor_readings.reading_value"):
        conform(readings.withColumn("reading_value", F.lit(None)), name).collect()
    with pytest.raises(PySparkException):
        conform(readings.withColumn("reading_value", F.lit("ten")), name).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "column, value",
    [
        ("reading_value", "1.00005"),
        ("reading_value", 1.00005),
        ("reading_value", "ten"),
        ("reading_id", 3.7),
        ("reading_id", "3.7"),
        ("is_anomaly", "perhaps"),
        ("created_at", "yesterday"),
    ],
)
def test_conform_never_rounds_or_drops(spark, readings, ansi, column, value):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            conform(readings.withColumn(column, F.lit(value)), "fact_sensor_readings").collect()
        good = readings.withColumn("reading_value", F.lit("1.0005")).withColumn("reading_id", F.lit(3.0))
        row = conform(good.withColumn("created_at", F.lit("2024-01-01T00:00:00+02:00")), "fact_sensor_readings").first()
        assert (row.reading_value, row.reading_id) == (Decimal("1.0005"), 3)
        assert row.created_at == datetime(2023, 12, 31, 22)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_contracts_can_be_added(spark, monkeypatch):
    schema = T.StructType(
        [T.StructField("k", T.LongType(), False), T.StructField("share", T.DoubleType(), False)]
    )
    monkeypatch.setitem(CONTRACTS, "shares", Contract("shares", "k", schema))
    df = spark.createDataFrame([(1, "0.5")], "k int, share string")
    assert tuples(conform(df, "shares")) == [(1, 0.5)]
    with pytest.raises(PySparkException, match="NULL in shares.share"):
        conform(df.withColumn("share", F.lit(None)), "shares").collect()


row = st.tuples(
    st.sampled_from(["S1", "S2", None]),
    st.decimals(min_value=-999, max_value=999, places=4),
    st.sampled_from([True, False, None]),
    st.integers(0, 30),
    st.integers(0, 2),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_merged_states_equal_direct_aggregate(spark, rows):
    ddl = "sensor_id string, reading_value decimal(10,4), is_anomaly boolean, h int, _delta_version long"
    df = spark.createDataFrame(rows, ddl).withColumn(
        "reading_timestamp",
        F.timestamp_add("MINUTE", F.col("h") * 25, F.lit("2026-05-01").cast("timestamp_ntz")),
    )
    for name in ("mv_sensor_hourly", "mv_anomaly_daily"):
        mart = MARTS[name]
        split = sorted(tuples(merge(partial(df, mart), mart)), key=repr)
        assert split == sorted(tuples(aggregate(df, mart)), key=repr)
