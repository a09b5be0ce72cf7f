"""Append-only versioned tables: one committed Parquet directory per version."""

from __future__ import annotations

from bisect import bisect_right
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.checks import require_same_schema
from millrace.operators.states import VERSION
from millrace.sources.files import ATTEMPT, commit, committed, committed_schema, data_dirs, newest, write_numbered


def with_version(df: DataFrame, v: int) -> DataFrame:
    return df.withColumn(VERSION, F.lit(v).cast("long"))


def committed_versions(spark: SparkSession, path: str, after: int | None = None) -> list[int]:
    return committed(spark, path, VERSION, after)


def current_version(spark: SparkSession, path: str) -> int | None:
    """Newest committed version, or ``None`` for a table that has none."""
    return newest(spark, path, VERSION)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Committed versions as rows, ascending. Comes from record names; no data file is opened."""
    rows = [(v,) for v in committed_versions(spark, path)]
    return spark.createDataFrame(rows, f"{VERSION} long")


def table_schema(spark: SparkSession, path: str, v: int) -> T.StructType:
    """Schema a version was committed with, without the version column."""
    return committed_schema(spark, path, VERSION, v)


def append_version(df: DataFrame, path: str, v: int) -> int:
    """Write ``df`` as version ``v`` and return its row count; no rows make no version.

    A version without commit record is replaced, a committed one is not. The schema must equal the
    table's.
    """
    spark = df.sparkSession
    df = df.drop(VERSION)
    current = current_version(spark, path)
    if current is not None:
        require_same_schema(table_schema(spark, path, current), df.schema, f"version {v} of {path}")
    return write_numbered(df, path, VERSION, v)


def _read(
    spark: SparkSession, path: str, wanted: list[int], current: int, schema: T.StructType | None
) -> DataFrame:
    """Rows of the wanted versions, whose directories alone are listed; none of them is no row."""
    # The version column is declared long: inference would make it int.
    fields = (schema or table_schema(spark, path, current)).fields
    columns = [f for f in fields if f.name != VERSION]
    full = T.StructType([*columns, T.StructField(VERSION, T.LongType())])
    dirs = data_dirs(spark, path, VERSION, wanted or [current])
    rows = spark.read.schema(full).option("basePath", path).parquet(*dirs).drop(ATTEMPT)
    return rows if wanted else rows.limit(0)


def read_versions(
    spark: SparkSession, path: str, wanted: list[int], schema: T.StructType | None = None
) -> DataFrame:
    """Rows of the given committed versions."""
    return _read(spark, path, wanted, wanted[-1], schema)


def as_of(
    spark: SparkSession, path: str, v: int | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of committed versions up to ``v``, by default of all."""
    return added_since(spark, path, None, v, schema)


def version_at(spark: SparkSession, path: str, when: datetime) -> int | None:
    """The newest version that was committed at a time (naive UTC), or ``None`` before the first.

    Versions are committed one after the other, so the records are searched by halves: a long history
    costs a few small reads. Clocks of several writers are not compared.
    """
    known = committed_versions(spark, path)
    at = bisect_right(known, when, key=lambda v: datetime.fromisoformat(commit(spark, path, VERSION, v)["committed_at"]))
    return known[at - 1] if at else None


def as_of_time(spark: SparkSession, path: str, when: datetime, schema: T.StructType | None = None) -> DataFrame:
    """Rows of the table as it was at a time (naive UTC): none before its first version."""
    v = version_at(spark, path, when)
    return as_of(spark, path, -1 if v is None else v, schema)


def added_since(
    spark: SparkSession,
    path: str,
    last_version: int | None,
    upto: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows added in versions ``last_version < v <= upto``, all up to ``upto`` without a last version.

    Only the directories of those versions are listed, so the cost follows the new data and not the
    length of the history.
    """
    known = committed_versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no committed version in {path}")
    wanted = [v for v in known if (last_version is None or v > last_version) and (upto is None or v <= upto)]
    return _read(spark, path, wanted, known[-1], schema)
