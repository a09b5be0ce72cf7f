"""Streams over commit records: stops between write and checkpoint, torn batches, one writer."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import millrace.plans.pipeline as pipeline
import millrace.streaming.ingest as ingest
from millrace.plans import read_mart, read_table, run_load, stream_load
from millrace.sources import as_of, land, read_progress, versions
from millrace.sources.files import write_numbered
from millrace.streaming import run_transform, stream_transform

NAME = "fact_sensor_readings"


def readings(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "reading_id long").select(
        "reading_id",
        F.lit("S1").alias("sensor_id"),
        F.lit(1).cast("decimal(10,4)").alias("reading_value"),
        (F.col("reading_id") % 2 == 0).alias("is_anomaly"),
        *[F.lit("2026-05-01 10:30:00").cast("timestamp_ntz").alias(c) for c in ("reading_timestamp", "created_at", "updated_at")],
    )


def put(spark, layout, seq, ids):
    land(readings(spark, ids), layout.landing(NAME), seq)


def table(spark, layout):
    return sorted((r.reading_id, r._delta_version) for r in as_of(spark, layout.table(NAME)).collect())


def known(spark, layout):
    return [r[0] for r in versions(spark, layout.table(NAME)).collect()]


def stop(*_):
    raise RuntimeError("stopped")


def test_versions_follow_the_micro_batches(spark, layout):
    for seq in range(3):
        put(spark, layout, seq, [seq * 10, seq * 10 + 1, seq * 10 + 1])
    stream_transform(spark, NAME, layout, most=2)
    assert table(spark, layout) == [(0, 0), (1, 0), (10, 0), (11, 0), (20, 1), (21, 1)]
    stream_transform(spark, NAME, layout)
    assert known(spark, layout) == [0, 1]
    put(spark, layout, 3, [30])
    stream_transform(spark, NAME, layout)
    assert known(spark, layout) == [0, 1, 2] and (30, 2) in table(spark, layout)


@pytest.mark.parametrize("where", ["write", "record", "checkpoint"])
def test_a_stop_anywhere_is_repeated_with_the_same_batches(spark, layout, monkeypatch, where):
    put(spark, layout, 0, [1, 2])
    with monkeypatch.context() as m:
        if where != "checkpoint":
            m.setattr(ingest, "append_version" if where == "write" else "write_last_seq", stop)
        with pytest.raises(StreamingQueryException, match="stopped"):
            stream_transform(spark, NAME, layout, written=stop)
    # What lands after the stop belongs to the next version.
    put(spark, layout, 1, [3])
    stream_transform(spark, NAME, layout)
    assert table(spark, layout) == [(1, 0), (2, 0), (3, 1)]


def test_torn_batches_and_torn_versions(spark, layout):
    put(spark, layout, 0, [1])
    readings(spark, [7]).write.parquet(f"{layout.landing(NAME)}/seq=1")
    readings(spark, [8]).write.parquet(f"{layout.table(NAME)}/_delta_version=0")
    stream_transform(spark, NAME, layout)
    assert table(spark, layout) == [(1, 0)]
    put(spark, layout, 1, [2])
    stream_transform(spark, NAME, layout)
    assert table(spark, layout) == [(1, 0), (2, 1)]


def test_stream_goes_on_where_runs_ended_and_is_the_only_writer(spark, layout):
    put(spark, layout, 0, [1])
    run_transform(spark, NAME, layout)
    put(spark, layout, 1, [2])
    stream_transform(spark, NAME, layout)
    assert table(spark, layout) == [(1, 0), (2, 1)]
    put(spark, layout, 2, [3])
    write_numbered(readings(spark, [9]), layout.table(NAME), "_delta_version", 2)
    with pytest.raises(StreamingQueryException, match="not this stream's"):
        stream_transform(spark, NAME, layout)


def test_nothing_landed_and_empty_versions(spark, layout):
    stream_transform(spark, NAME, layout)
    stream_load(spark, NAME, layout)
    assert known(spark, layout) == [] and read_progress(spark, layout.state("load", NAME)) is None


@pytest.mark.parametrize("where", ["append_version", "refresh_marts", "write_progress", "checkpoint"])
def test_load_stopped_anywhere_counts_every_version_once(spark, layout, monkeypatch, where):
    for seq in range(3):
        put(spark, layout, seq, [seq * 10, seq * 10 + 1])
    stream_transform(spark, NAME, layout, most=1)
    with monkeypatch.context() as m:
        if where != "checkpoint":
            m.setattr(pipeline, where, stop)
        with pytest.raises(StreamingQueryException, match="stopped"):
            stream_load(spark, NAME, layout, most=2, loaded=stop)
    stream_load(spark, NAME, layout, most=2)
    loaded = sorted((r.reading_id, r._delta_version) for r in read_table(spark, layout, NAME).collect())
    assert loaded == table(spark, layout) and len(loaded) == 6
    assert [tuple(r)[1:] for r in read_mart(spark, layout, "mv_anomaly_daily").collect()] == [(3, 6)]
    assert read_progress(spark, layout.state("load", NAME)).last_version == 2


def test_stream_and_run_share_the_load_progress(spark, layout):
    put(spark, layout, 0, [1])
    stream_transform(spark, NAME, layout)
    run_load(spark, NAME, layout)
    put(spark, layout, 1, [2])
    stream_transform(spark, NAME, layout)
    stream_load(spark, NAME, layout)
    assert read_mart(spark, layout, "mv_anomaly_daily").first().total_readings == 2
    assert run_load(spark, NAME, layout) == 0
