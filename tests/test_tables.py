"""Landing batches, versioned tables and progress records."""

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from threading import Barrier

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import clean, latest_by_key
from millrace.sources import (
    JdbcSource,
    TableSpec,
    added_since,
    append_version,
    as_of,
    committed_versions,
    current_version,
    land,
    land_files,
    landed,
    read_progress,
    read_watermark,
    scan_landing,
    scan_new_files,
    versions,
    write_progress,
    write_watermark,
)
from millrace.sources import files as numbered_files
from millrace.sources.files import _rename, committed, numbered, read_json, write_json, write_numbered
from millrace.sources.progress import write_record
from millrace.sources.relation import bounds_text, select_text, split_options


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in range(3):
        append_version(spark.range(v * 10, v * 10 + 10), path, v)
    return path


def ids(df):
    return sorted(r.id for r in df.collect())


def test_versions_and_slices(spark, table):
    assert current_version(spark, table) == 2
    assert [r[0] for r in versions(spark, table).collect()] == [0, 1, 2]
    assert as_of(spark, table).schema["_delta_version"].dataType == T.LongType()
    assert ids(as_of(spark, table, 1)) == list(range(20))
    assert ids(added_since(spark, table, None)) == list(range(30))
    assert ids(added_since(spark, table, 0)) == list(range(10, 30))
    assert ids(added_since(spark, table, 0, 1)) == list(range(10, 20))
    assert ids(added_since(spark, table, 2)) == []


def test_a_committed_version_is_never_rewritten(spark, table):
    with pytest.raises(FileExistsError):
        append_version(spark.range(5), table, 2)
    assert ids(added_since(spark, table, 1)) == list(range(20, 30))


def test_reading_and_appending_open_no_footer(spark, table):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "")
    as_of(spark, table), added_since(spark, table, 0)
    assert len(tracker.getJobIdsForGroup("footers")) == 0
    append_version(spark.range(30, 35), table, 3)
    assert len(tracker.getJobIdsForGroup("footers")) <= 3
    spark.sparkContext.setJobGroup("", "")


def test_no_rows_make_no_version(spark, table):
    assert append_version(spark.range(0), table, 3) == 0
    assert current_version(spark, table) == 2
    assert not os.path.exists(f"{table}/_delta_version=3")


@pytest.mark.parametrize(
    "empty",
    [
        lambda df: df.limit(0),
        lambda df: df.filter(F.lit(False)),
        lambda df: clean(df.filter("id < 0")),
        lambda df: clean(df.filter(F.rand() < -1)),
        lambda df: latest_by_key(df.filter("id < 0").withColumn("_delta_version", F.lit(1)), ["id"]),
    ],
)
def test_emptiness_is_seen_however_the_plan_folds(spark, table, empty):
    assert append_version(empty(spark.range(100)), table, 3) == 0
    assert current_version(spark, table) == 2


def test_schema_is_enforced(spark, table):
    with pytest.raises(ValueError, match="schema mismatch"):
        append_version(spark.range(3).withColumn("x", F.lit(1)), table, 3)
    with pytest.raises(ValueError, match="schema mismatch"):
        append_version(spark.range(3).select(F.col("id").cast("string")), table, 3)


def test_unfinished_version_is_invisible(spark, table):
    spark.range(100, 110).write.parquet(numbered(table, "_delta_version", 3))
    os.remove(f"{table}/_committed/_delta_version=0")
    assert current_version(spark, table) == 2
    assert committed_versions(spark, table) == [1, 2]
    assert ids(as_of(spark, table)) == list(range(10, 30))
    assert ids(as_of(spark, table, 0)) == []
    assert ids(added_since(spark, table, 1)) == list(range(20, 30))
    assert append_version(spark.range(100, 103), table, 3) == 3
    assert ids(added_since(spark, table, 2)) == [100, 101, 102]


def test_missing_table(spark, tmp_path):
    path = str(tmp_path / "none")
    assert current_version(spark, path) is None
    assert versions(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        as_of(spark, path)


def test_landing(spark, tmp_path):
    path = str(tmp_path / "landing")
    assert land(spark.range(4), path, 0) == 4
    assert land(spark.range(0), path, 1) == 0
    assert land(spark.range(4, 6), path, 1) == 2
    assert landed(spark, path) == [0, 1] and landed(spark, path, 0) == [1]
    spark.range(99).write.parquet(f"{path}/seq=2")
    spark.range(99).write.parquet(f"{path}/from_elsewhere")
    scan = scan_landing(spark, path)
    assert scan.columns == ["id"] and ids(scan) == list(range(6))
    assert ids(scan_new_files(spark, path, 0)) == [4, 5] and ids(scan_new_files(spark, path, 1)) == []
    assert land_files(spark, [f"{path}/from_elsewhere"], path) == 99
    assert landed(spark, path) == [0, 1, 2] and ids(scan_new_files(spark, path, 1)) == list(range(99))


def test_watermark_record(spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_watermark(spark, path) is None
    write_watermark(spark, path, 0, "t", "updated_at", None, None, None)
    assert read_watermark(spark, path) is None
    first, second = datetime(2026, 5, 1, 1, 2, 3, 456789), datetime(2026, 5, 2)
    write_watermark(spark, path, 0, "t", "updated_at", "k", first, 42)
    assert read_watermark(spark, path) == (0, first, "42")
    write_watermark(spark, path, 10, "t", "updated_at", "k", second, None)
    assert read_watermark(spark, path) == (10, second, None)


def test_load_record(spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_progress(spark, path) is None
    write_progress(spark, path, "t", "k", 3, 17)
    row = read_progress(spark, path)
    assert (row.table, row.unique_key, row.last_version, row.rows) == ("t", "k", 3, 17)


@pytest.mark.parametrize("text", ['{"table":"t","last_value":"yesterday"}', "not json", '{"table":"t"}', ""])
def test_bad_watermark_is_rejected(spark, tmp_path, text):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "0.json").write_text(text)
    with pytest.raises(ValueError, match="progress record"):
        read_watermark(spark, str(tmp_path / "state"))


def test_jdbc_texts():
    jdbc = JdbcSource({"url": "jdbc:x"}, num_partitions=8)
    plain = TableSpec("public.orders", jdbc=jdbc)
    custom = TableSpec("o", query=" select a, updated_at from b ; ", jdbc=jdbc)
    assert select_text(plain) == 'SELECT * FROM "public"."orders"'
    assert select_text(custom) == "select a, updated_at from b"
    assert bounds_text(custom, "updated_at", datetime(2026, 5, 1, 0, 0, 0, 7)) == (
        'SELECT max("updated_at") AS hi, min("updated_at") AS split_lo, max("updated_at") AS split_hi '
        "FROM (select a, updated_at from b) AS src "
        "WHERE \"updated_at\" >= TIMESTAMP '2026-04-30 00:00:00.000007'"
    )
    assert split_options(jdbc, "updated_at", "a", "b") == {
        "partitionColumn": "updated_at",
        "lowerBound": "a",
        "upperBound": "b",
        "numPartitions": 8,
    }
    assert split_options(JdbcSource(num_partitions=1), "updated_at", "a", "b") == {}
    with pytest.raises(ValueError, match="partitions"):
        JdbcSource()
    assert split_options(jdbc, "updated_at", None, None) == {}
    by_key = JdbcSource(partition_column="order_key", num_partitions=2)
    assert 'min("order_key") AS split_lo' in bounds_text(TableSpec("o", jdbc=by_key), "updated_at", None)


def test_snapshot_by_time(spark, tmp_path):
    """The version committed at a time: none before the first, the newest after the last."""
    from datetime import UTC, datetime

    from millrace.sources import as_of_time
    from millrace.sources.versioned import version_at

    path, times = str(tmp_path / "t"), []
    for v in range(5):
        times.append(datetime.now(UTC).replace(tzinfo=None))
        append_version(spark.range(v + 1).toDF("id"), path, 2 * v)
    times.append(datetime.now(UTC).replace(tzinfo=None))
    assert [version_at(spark, path, t) for t in times] == [None, 0, 2, 4, 6, 8]
    assert [as_of_time(spark, path, t).count() for t in times] == [0, 1, 3, 6, 10, 15]
    assert as_of_time(spark, path, times[0]).columns == ["id", "_delta_version"]


def test_two_writers_of_one_number(spark, tmp_path, monkeypatch):
    """Both see the number free and write their data; one commits, the other raises and leaves nothing."""
    path, both = str(tmp_path / "t"), Barrier(2)
    write = numbered_files.write_json

    def after_both(*args):
        both.wait(60)
        write(*args)

    monkeypatch.setattr(numbered_files, "write_json", after_both)

    def writer(k):
        try:
            return write_numbered(spark.range(k * 100, k * 100 + 10 + k), path, "n", 0)
        except FileExistsError:
            return None

    with ThreadPoolExecutor(2) as pool:
        rows = list(pool.map(writer, [0, 1]))
    winner = rows.index(next(r for r in rows if r))
    assert rows[1 - winner] is None
    assert committed(spark, path, "n") == [0] and numbered_files.commit(spark, path, "n", 0)["rows"] == 10 + winner
    assert ids(spark.read.parquet(*numbered_files.data_dirs(spark, path, "n", [0]))) == list(range(100 * winner, 100 * winner + 10 + winner))
    assert len(os.listdir(f"{path}/n=0")) == 1 and [f for f in os.listdir(f"{path}/_committed") if not f.endswith(".crc")] == ["n=0"]


def test_records_are_created_not_replaced(spark, tmp_path):
    path = str(tmp_path / "state" / "1.json")
    write_json(spark, path, {"a": 1})
    with pytest.raises(FileExistsError):
        write_json(spark, path, {"a": 2})
    assert read_json(spark, path) == {"a": 1}
    write_record(spark, str(tmp_path / "p"), 3, version=3)
    write_record(spark, str(tmp_path / "p"), 3, version=3)  # a repeated step
    with pytest.raises(FileExistsError):
        write_record(spark, str(tmp_path / "p"), 3, version=4)


def test_rename_of_other_file_systems_keeps_what_is_there(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(numbered_files, "_link", _rename)
    path = str(tmp_path / "r" / "x")
    write_json(spark, path, {"a": 1})
    with pytest.raises(FileExistsError):
        write_json(spark, path, {"a": 2})
    assert read_json(spark, path) == {"a": 1}


def test_a_stopped_attempt_goes_when_another_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(f"{path}/n=0/_attempt=a1")
    write_numbered(spark.range(7), path, "n", 0)
    assert len(os.listdir(f"{path}/n=0")) == 1
    assert ids(spark.read.parquet(*numbered_files.data_dirs(spark, path, "n", [0]))) == list(range(7))
