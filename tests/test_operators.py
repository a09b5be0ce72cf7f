"""Operators on hand-written rows."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import band, pct, start_of_hour
from millrace.operators import (
    advance_watermark,
    cast_time_columns,
    clean,
    concat_strict,
    deterministic_sort,
    drop_exact_duplicates,
    latest_by_key,
    require_columns,
    scan_since,
    sort_columns,
    to_naive_utc,
)

DAY1, DAY2 = datetime(2026, 5, 1), datetime(2026, 5, 2)


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_start_of_hour_in_any_zone(spark, zone):
    # 02:30 on 10 March 2024 does not exist in New York.
    df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.5' as t").select(
        start_of_hour(F.col("t")).alias("h")
    )
    assert df.schema["h"].dataType == T.TimestampNTZType()
    assert tuples(df) == [(datetime(2024, 3, 10, 2),)]


def test_to_naive_utc_in_any_zone(spark, zone):
    # Both instants read 01:30 on New York clocks.
    df = spark.sql(
        "select timestamp'2024-11-03 05:30:00.000001+00:00' a, timestamp'2024-11-03 07:30:00+01:00' b,"
        " timestamp_ntz'2024-11-03 01:30:00' c, 'x' s"
    )
    assert tuples(to_naive_utc(df)) == [
        (datetime(2024, 11, 3, 5, 30, 0, 1), datetime(2024, 11, 3, 6, 30), datetime(2024, 11, 3, 1, 30), "x")
    ]


def test_cast_time_columns(spark, zone):
    df = spark.sql(
        "select '2026-05-01 10:00:00.123456' as Event_Timestamp, 1714557600123456L as created_at,"
        " date'2026-05-01' as updated_at, timestamp_ntz'2026-05-01 01:00:00' as row_updated_at_2,"
        " '2026-05-01' as start_time"
    )
    out = cast_time_columns(df)
    assert out.columns == df.columns
    assert tuples(out) == [
        (
            datetime(2026, 5, 1, 10, 0, 0, 123456),
            datetime(2024, 5, 1, 10, 0, 0, 123456),
            DAY1,
            datetime(2026, 5, 1, 1),
            "2026-05-01",
        )
    ]


def test_cast_keeps_zoned_and_rejects_bad_text(spark):
    zoned = spark.sql("select timestamp'2026-05-01 00:00:00+00:00' as created_at")
    assert cast_time_columns(zoned).schema["created_at"].dataType == T.TimestampType()
    with pytest.raises(PySparkException):
        cast_time_columns(spark.sql("select 'soon' as created_at")).collect()


def test_exact_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a")], "k int, v string")
    assert sorted(tuples(drop_exact_duplicates(df)), key=str) == [(1, "a"), (1, None), (2, "a")]


def test_sort_columns(spark):
    df = spark.sql(
        "select 1 as updated_at, 1 as reading_timestamp, 1 as machine_id, 1 as ID, 1 as id,"
        " 1 as Order_Id, 1 as timestamp, 1 as created_at"
    )
    assert sort_columns(df) == ["updated_at", "machine_id", "id", "timestamp", "created_at"]


def test_deterministic_sort_orders_whole_output(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 13).alias("machine_id"),
        (F.col("id") % 5).alias("updated_at"),
        "id",
    ).repartition(6)
    keys = [tuple(-1 if v is None else v for v in r) for r in deterministic_sort(df).collect()]
    assert len(keys) == 2000 and keys == sorted(keys)


def test_sort_without_sort_columns_is_a_no_op(spark):
    df = spark.range(3).toDF("n")
    assert deterministic_sort(df) is df


def test_concat_strict(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert tuples(concat_strict(a, b)) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="schema mismatch"):
        concat_strict(a, spark.createDataFrame([(1, "x")], "k bigint, v string"))
    with pytest.raises(ValueError, match="schema mismatch"):
        concat_strict(a, a.withColumn("w", F.lit(1)))


def test_require_columns(spark):
    df = spark.range(1)
    assert require_columns(df, "id", None) is df
    with pytest.raises(ValueError, match="updated_at"):
        require_columns(df, "updated_at")


def test_latest_by_key_order_of_ties(spark):
    rows = [
        ("a", 1, DAY1, "old"),
        ("a", 0, DAY2, "lower version"),
        ("b", 1, None, "no time"),
        ("b", 1, DAY1, "time"),
        ("c", 1, DAY1, "p"),
        ("c", 1, DAY1, "q"),
        (None, 1, DAY1, "null key"),
    ]
    df = spark.createDataFrame(rows, "k string, _delta_version long, updated_at timestamp_ntz, v string")
    got = {r.k: r.v for r in latest_by_key(df, ["k"]).collect()}
    assert got == {"a": "old", "b": "time", "c": "q", None: "null key"}


MARKS = [(DAY1, 1), (DAY2, None), (DAY2, 7), (None, 99), (DAY2, 3)]


@pytest.mark.parametrize(
    ("prior", "expected"),
    [
        (None, (DAY2, 7)),
        ((DAY1, 9), (DAY2, 7)),
        ((DAY2, None), (DAY2, 7)),
        ((DAY2, 8), (DAY2, 8)),
        ((datetime(2027, 1, 1), 1), (datetime(2027, 1, 1), 1)),
    ],
)
def test_watermark_fold(spark, prior, expected):
    df = spark.createDataFrame(MARKS, "t timestamp_ntz, k int")
    assert tuples(advance_watermark(df, "t", "k", prior)) == [expected]


def test_watermark_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "t timestamp_ntz, k int")
    assert tuples(advance_watermark(df, "t", "k")) == [(None, None)]
    assert tuples(advance_watermark(df, "t", "k", (DAY1, 4))) == [(DAY1, 4)]
    assert tuples(advance_watermark(df.limit(0), "t", None, (DAY1, None))) == [(DAY1, None)]


def test_watermark_must_be_a_timestamp(spark):
    df = spark.createDataFrame([(date(2026, 5, 1), 1)], "t date, k int")
    with pytest.raises(TypeError, match="timestamp"):
        advance_watermark(df, "t", "k")
    with pytest.raises(TypeError, match="timestamp"):
        scan_since(df, "t", DAY1)


def test_zoned_watermark_column(spark, zone):
    df = spark.sql(
        "select timestamp'2026-05-01 02:00:00+02:00' as t, 1 as k union all"
        " select timestamp'2026-05-01 00:00:00.000001+00:00', 2"
    )
    assert tuples(advance_watermark(df, "t", "k")) == [(datetime(2026, 5, 1, 0, 0, 0, 1), 2)]
    assert [r.k for r in scan_since(df, "t", DAY1).collect()] == [2]


def test_slices_by_time_and_key_equal_one_scan(spark):
    """Reading in slices, each from the mark of the one before, yields every row once."""
    df = spark.range(500).select(
        F.timestamp_add("DAY", F.col("id") % 7, F.lit("2026-05-01").cast("timestamp_ntz")).alias("t"),
        F.col("id").alias("k"),
    )
    seen, mark = [], None
    while True:
        rest = scan_since(df, "t", mark and mark[0], "k", mark and mark[1])
        part = rest.orderBy("t", "k").limit(37)
        rows = tuples(part)
        if not rows:
            break
        seen += rows
        mark = advance_watermark(part, "t", "k", mark).first()
    assert len(seen) == 500 and sorted(seen) == sorted(tuples(df))


def test_pct_rounds_half_to_even_and_guards_zero(spark):
    df = spark.createDataFrame([(1, 800), (3, 800), (1, 0), (None, 5)], "a long, b long")
    assert tuples(df.select(pct(F.col("a"), F.col("b"), 2))) == [(0.12,), (0.38,), (None,), (None,)]


@pytest.mark.parametrize(
    ("value", "colour"),
    [(90.0, "green"), (90.0001, "orange"), (95.0, "orange"), (95.0001, "red"), (None, "green")],
)
def test_band_edges(spark, value, colour):
    df = spark.createDataFrame([(value,)], "v double")
    assert tuples(df.select(band(F.col("v"), 90, 95))) == [(colour,)]


def test_clean_drops_within_a_batch_and_sorts(spark):
    rows = [(2, "2026-05-01 00:00:00"), (1, "2026-05-02 00:00:00"), (2, "2026-05-01 00:00:00")]
    df = spark.createDataFrame(rows, "order_id int, updated_at string")
    assert tuples(clean(df)) == [(1, DAY2), (2, DAY1)]
