"""Whole runs: increments, replays and stops in the middle."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import millrace.plans.marts as marts
import millrace.plans.pipeline as pipeline
import millrace.streaming.ingest as ingest
from millrace.plans import (
    latest_table,
    read_mart,
    read_table,
    run_extract,
    run_load,
    run_pipeline,
    run_stage,
)
from millrace.sources import (
    TableSpec,
    as_of,
    current_version,
    land,
    landed,
    read_progress,
    read_watermark,
    versions,
)
from millrace.sources.progress import read_record
from millrace.streaming import run_transform

NAME = "fact_sensor_readings"
SPEC = TableSpec(f"public.{NAME}", query="select * from src_readings")
T0 = datetime(2026, 5, 1, 10)


def source(spark, rows):
    """``(id, anomaly, changed)`` rows as the source table."""
    df = spark.createDataFrame(rows, "reading_id long, is_anomaly boolean, updated_at timestamp_ntz")
    df.select(
        "reading_id",
        F.lit("S1").alias("sensor_id"),
        F.lit(1).cast("decimal(10,4)").alias("reading_value"),
        "is_anomaly",
        F.lit("2026-05-01 10:30:00").cast("timestamp_ntz").alias("reading_timestamp"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        "updated_at",
    ).createOrReplaceTempView("src_readings")


def at(minute):
    return T0.replace(minute=minute)


BASE = [(1, True, at(1)), (2, False, at(2)), (3, None, at(2))]


def warehouse(spark, layout):
    rows = read_table(spark, layout, NAME)
    return sorted((r.reading_id, r._delta_version) for r in rows.collect())


def test_increment_replay_and_update(spark, layout):
    source(spark, BASE)
    assert run_pipeline(spark, [SPEC], layout) == {"extract": [3], "transform": [3], "load": [3]}
    for _ in range(2):
        assert run_pipeline(spark, [SPEC], layout) == {"extract": [0], "transform": [0], "load": [0]}
    # A later row with the same time as the mark, an update, and an older row that stays unread.
    source(spark, [*BASE[1:], (4, True, at(2)), (1, False, at(9)), (0, True, at(2))])
    assert run_pipeline(spark, [SPEC], layout) == {"extract": [2], "transform": [2], "load": [2]}
    assert warehouse(spark, layout) == [(1, 0), (1, 1), (2, 0), (3, 0), (4, 1)]
    newest = {r.reading_id: r.is_anomaly for r in latest_table(spark, layout, NAME).collect()}
    assert newest == {1: False, 2: False, 3: None, 4: True}
    # The mart counts the update again, as a mart fed by inserts does.
    assert read_mart(spark, layout, "mv_anomaly_daily").first()[1:] == (2, 5)
    assert read_mart(spark, layout, "mv_sensor_hourly").first().readings == 5
    mark = read_watermark(spark, layout.state("extract", SPEC.name))
    assert mark == (1, at(9), "1")
    assert read_progress(spark, layout.state("load", NAME)).last_version == 1


def test_stop_after_landing_keeps_the_batch(spark, layout, monkeypatch):
    source(spark, BASE)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "_advance", lambda *a: (_ for _ in ()).throw(OSError("lost driver")))
        with pytest.raises(OSError):
            run_extract(spark, SPEC, layout)
    source(spark, [*BASE, (5, None, at(5))])
    assert run_extract(spark, SPEC, layout) == 1
    assert landed(spark, layout.landing(SPEC.name)) == [0, 1]
    assert run_transform(spark, SPEC.name, layout) == 4


def test_stop_while_landing_is_overwritten(spark, layout):
    source(spark, BASE)
    path = layout.landing(SPEC.name)
    spark.table("src_readings").limit(1).write.parquet(f"{path}/seq=0")
    assert run_extract(spark, SPEC, layout) == 3
    assert landed(spark, path) == [0]


def test_torn_batch_is_left_for_the_repeated_extract(spark, layout):
    source(spark, BASE)
    run_extract(spark, SPEC, layout)
    source(spark, [*BASE, (4, True, at(3)), (5, True, at(4))])
    spark.table("src_readings").filter("reading_id = 4").write.parquet(f"{layout.landing(SPEC.name)}/seq=1")
    assert run_transform(spark, SPEC.name, layout) == 3
    assert run_extract(spark, SPEC, layout) == 2
    assert run_transform(spark, SPEC.name, layout) == 2
    assert as_of(spark, layout.table(NAME)).count() == 5


def test_stop_after_version_write_only_records_it(spark, layout, monkeypatch):
    source(spark, BASE)
    run_extract(spark, SPEC, layout)
    with monkeypatch.context() as m:
        m.setattr(ingest, "write_last_seq", lambda *a: (_ for _ in ()).throw(OSError("lost driver")))
        with pytest.raises(OSError):
            run_transform(spark, SPEC.name, layout)
    # A batch landed meanwhile belongs to the next version.
    source(spark, [*BASE, (5, None, at(5))])
    run_extract(spark, SPEC, layout)
    assert run_transform(spark, SPEC.name, layout) == 3
    number, record = read_record(spark, layout.state("transform", NAME))
    assert (number, record["raw_rows"], record["clean_rows"], record["version"]) == (0, 3, 3, 0)
    assert run_transform(spark, SPEC.name, layout) == 1
    assert [r[0] for r in versions(spark, layout.table(NAME)).collect()] == [0, 1]
    assert as_of(spark, layout.table(NAME)).count() == 4


def test_stop_before_version_commit_repeats_the_same_batches(spark, layout, monkeypatch):
    land(spark.range(3).toDF("id"), layout.landing("t"), 0)
    with monkeypatch.context() as m:
        m.setattr(ingest, "append_version", lambda *a: (_ for _ in ()).throw(OSError("lost driver")))
        with pytest.raises(OSError):
            run_transform(spark, "t", layout)
    land(spark.range(3, 5).toDF("id"), layout.landing("t"), 1)
    assert [run_transform(spark, "t", layout) for _ in range(3)] == [3, 2, 0]


def test_row_counters(spark, layout):
    rows = spark.createDataFrame([(i % 6, "x") for i in range(9)], "order_id int, v string")
    land(rows, layout.landing("t"), 0)
    run_transform(spark, "t", layout)
    _, record = read_record(spark, layout.state("transform", "t"))
    assert (record["raw_rows"], record["clean_rows"]) == (9, 6)


def test_stopped_load_keeps_what_it_committed(spark, layout, monkeypatch):
    for seq, n in enumerate((3, 4)):
        source(spark, [(seq * 10 + i, True, at(seq * 10 + i)) for i in range(n)])
        run_extract(spark, SPEC, layout)
        run_transform(spark, SPEC.name, layout)
    real, calls = pipeline.append_version, []

    def stop_second(df, path, v):
        calls.append(v)
        if v == 1:
            raise OSError("lost driver")
        return real(df, path, v)

    with monkeypatch.context() as m:
        m.setattr(pipeline, "append_version", stop_second)
        for _ in range(2):
            with pytest.raises(OSError):
                run_load(spark, NAME, layout)
            assert len(warehouse(spark, layout)) == 3
    assert calls == [0, 1, 1]  # the committed version is not written again
    assert run_load(spark, NAME, layout) == 7
    assert len(warehouse(spark, layout)) == 7
    assert read_mart(spark, layout, "mv_anomaly_daily").first().total_readings == 7


def test_job_count_of_a_run(spark, layout):
    source(spark, BASE)
    run_pipeline(spark, [SPEC], layout, parallel=1)
    source(spark, [*BASE, (4, True, at(5))])
    spark.sparkContext.setJobGroup("run", "")
    seen = set()
    for step in (
        lambda: run_extract(spark, SPEC, layout),
        lambda: run_transform(spark, SPEC.name, layout),
        lambda: run_load(spark, NAME, layout),
    ):
        step()
        seen |= set(spark.sparkContext.statusTracker().getJobIdsForGroup("run"))
    spark.sparkContext.setJobGroup("", "")
    assert len(seen) <= 25


def test_failed_load_is_repeated_whole(spark, layout, monkeypatch):
    source(spark, BASE)
    run_extract(spark, SPEC, layout)
    run_transform(spark, SPEC.name, layout)
    done = []

    def fail_second(*args):
        if done:
            raise OSError("lost driver")
        done.append(pipeline_refresh(*args))

    pipeline_refresh = marts.refresh_mart
    with monkeypatch.context() as m:
        m.setattr(marts, "refresh_mart", fail_second)
        with pytest.raises(OSError):
            run_load(spark, NAME, layout)
    assert read_progress(spark, layout.state("load", NAME)) is None
    assert run_load(spark, NAME, layout) == 3
    assert warehouse(spark, layout) == [(1, 0), (2, 0), (3, 0)]
    assert read_mart(spark, layout, "mv_anomaly_daily").first().total_readings == 3
    assert read_mart(spark, layout, "mv_sensor_hourly").first().readings == 3


def test_duplicates_drop_within_a_batch_only(spark, layout):
    rows = spark.createDataFrame([(i % 6, "x") for i in range(9)], "order_id int, v string")
    land(rows, layout.landing("t"), 0)
    assert run_transform(spark, "t", layout) == 6
    assert run_transform(spark, "t", layout) == 0
    land(rows.filter("order_id < 3").distinct(), layout.landing("t"), 1)
    assert run_transform(spark, "t", layout) == 3
    counts = as_of(spark, layout.table("t")).groupBy("_delta_version").count()
    assert sorted(tuple(r) for r in counts.collect()) == [(0, 6), (1, 3)]


def test_batches_landed_between_two_runs_are_one_version(spark, layout):
    for seq in range(3):
        land(spark.range(seq, seq + 3).toDF("id"), layout.landing("t"), seq)
    assert run_transform(spark, "t", layout) == 5
    assert current_version(spark, layout.table("t")) == 0


def test_landed_batches_must_agree(spark, layout):
    land(spark.range(3).toDF("id"), layout.landing("t"), 0)
    land(spark.range(3).selectExpr("cast(id as string) as id"), layout.landing("t"), 1)
    with pytest.raises(ValueError, match="landed batch 0"):
        run_transform(spark, "t", layout)


def test_changed_schema_does_not_reach_the_table(spark, layout):
    land(spark.range(3).toDF("id"), layout.landing("t"), 0)
    run_transform(spark, "t", layout)
    land(spark.range(3).selectExpr("cast(id as string) as id"), layout.landing("t"), 1)
    with pytest.raises(ValueError, match="schema mismatch"):
        run_transform(spark, "t", layout)


def test_rows_without_time_are_read_on_the_first_run_only(spark, layout):
    source(spark, [*BASE, (7, None, None)])
    assert run_extract(spark, SPEC, layout) == 4
    source(spark, [*BASE, (7, None, None), (8, None, None)])
    assert run_extract(spark, SPEC, layout) == 0


def test_without_any_time_every_run_is_full(spark, layout):
    source(spark, [(1, None, None), (2, None, None)])
    assert run_extract(spark, SPEC, layout) == 2
    assert run_extract(spark, SPEC, layout) == 2
    assert read_watermark(spark, layout.state("extract", SPEC.name)) is None
    assert landed(spark, layout.landing(SPEC.name)) == [0, 1]


def test_without_a_key_ties_of_the_mark_are_not_read_again(spark, layout):
    spark.createDataFrame([(1, at(1))], "n int, updated_at timestamp_ntz").createOrReplaceTempView("log")
    assert run_extract(spark, TableSpec("log"), layout) == 1
    rows = [(1, at(1)), (2, at(1)), (3, at(2))]
    spark.createDataFrame(rows, "n int, updated_at timestamp_ntz").createOrReplaceTempView("log")
    assert run_extract(spark, TableSpec("log"), layout) == 1


def test_increment_from_many_files_lands_in_few(spark, layout, tmp_path):
    def write(start):
        df = spark.range(start, start + 400).select(
            F.col("id").alias("k"),
            F.timestamp_add("SECOND", F.col("id"), F.lit("2026-05-01").cast("timestamp_ntz")).alias(
                "updated_at"
            ),
        )
        df.repartition(40).write.mode("append").parquet(str(tmp_path / "source"))
        spark.read.parquet(str(tmp_path / "source")).createOrReplaceTempView("many_files")

    spec = TableSpec("many_files", "k")
    for seq, start in enumerate((0, 400)):
        write(start)
        assert run_extract(spark, spec, layout) == 400
        batch = f"{layout.landing("many_files")}/seq={seq}"
        files = [f for attempt in os.listdir(batch) for f in os.listdir(f"{batch}/{attempt}") if f.endswith("parquet")]
        assert seq == 0 or len(files) == 1


def test_rejected_sources(spark, layout):
    spark.range(1).createOrReplaceTempView("plain")
    with pytest.raises(ValueError, match="updated_at"):
        run_extract(spark, TableSpec("plain"), layout)
    spark.sql("select 1 as k, 'now' as updated_at").createOrReplaceTempView("text_time")
    with pytest.raises(TypeError, match="timestamp"):
        run_extract(spark, TableSpec("text_time"), layout)
    spark.sql("select 1 as k, timestamp_ntz'2026-05-01' as updated_at").createOrReplaceTempView("no_key")
    with pytest.raises(ValueError, match="order_id"):
        run_extract(spark, TableSpec("no_key", "order_id"), layout)


def test_empty_source_and_missing_table(spark, layout):
    source(spark, [])
    assert run_pipeline(spark, [SPEC], layout) == {"extract": [0], "transform": [0], "load": []}
    with pytest.raises(FileNotFoundError):
        run_load(spark, NAME, layout)


def test_stage_order_and_failure():
    started = []

    def stage(n):
        started.append(n)
        if n == 2:
            raise OSError("table 2")
        return n * 10

    assert run_stage(stage, [3, 1], parallel=2) == [30, 10]
    assert run_stage(stage, []) == []
    started.clear()
    with pytest.raises(OSError, match="table 2"):
        run_stage(stage, [1, 2, 3, 4])
    assert started[:2] == [1, 2] and 4 not in started


def test_names_must_not_clash(spark, layout):
    with pytest.raises(ValueError, match="share the folder"):
        run_pipeline(spark, [TableSpec("x.a"), TableSpec("y.a")], layout)
    with pytest.raises(ValueError, match="share the folder"):
        run_pipeline(spark, [TableSpec("a.b_c"), TableSpec("a_b.c")], layout)


def test_zoned_source_times_reach_the_warehouse_as_utc(spark, layout):
    spark.sql(
        "select 1L as reading_id, 'S1' as sensor_id, cast(1 as decimal(10,4)) as reading_value,"
        " true as is_anomaly, timestamp'2026-05-01 12:30:00+02:00' as reading_timestamp,"
        " timestamp'2026-05-01 12:30:00+02:00' as created_at,"
        " timestamp'2026-05-01 12:30:00.000001+02:00' as updated_at"
    ).createOrReplaceTempView("src_readings")
    run_pipeline(spark, [SPEC], layout)
    row = read_table(spark, layout, NAME).first()
    assert row.reading_timestamp == datetime(2026, 5, 1, 10, 30)
    assert row.updated_at == datetime(2026, 5, 1, 10, 30, 0, 1)
    assert run_extract(spark, SPEC, layout) == 0
