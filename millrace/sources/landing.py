"""Landing zone: one immutable Parquet directory per extracted batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.operators.checks import require_same_schema
from millrace.sources.files import committed, commits, committed_schema, data_dirs, write_numbered

SEQ = "seq"


def land(df: DataFrame, path: str, seq: int) -> int:
    """Write one batch and return its row count; an empty batch leaves nothing behind."""
    return write_numbered(df, path, SEQ, seq)


def land_files(spark: SparkSession, files: list[str], path: str) -> int:
    """Take Parquet files of another tool in as the next batch. Nothing else enters the landing zone."""
    after = landed(spark, path)
    return land(spark.read.parquet(*files), path, after[-1] + 1 if after else 0)


def landed(spark: SparkSession, path: str, after: int | None = None) -> list[int]:
    """Numbers of committed batches above ``after``, ascending."""
    return committed(spark, path, SEQ, after)


def landed_schema(spark: SparkSession, path: str, seq: int) -> T.StructType:
    return committed_schema(spark, path, SEQ, seq)


def landed_rows(spark: SparkSession, path: str, seqs: list[int]) -> int:
    """Rows of the given batches, from their commit records."""
    return sum(r["rows"] for r in commits(spark, path, SEQ, seqs))


def batches(spark: SparkSession, path: str, seqs: list[int], schema: T.StructType) -> DataFrame:
    """Rows of the given batches; no other directory is listed, no footer opened for the schema."""
    return spark.read.schema(schema).parquet(*data_dirs(spark, path, SEQ, seqs))


def scan_new_files(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """Rows of the committed batches above ``after``, which must share one schema."""
    seqs = landed(spark, path, after)
    if not seqs:
        known = landed(spark, path)
        if not known:
            raise FileNotFoundError(f"no landed batch in {path}")
        return batches(spark, path, known[-1:], landed_schema(spark, path, known[-1])).limit(0)
    schema = landed_schema(spark, path, seqs[-1])
    for seq in seqs[:-1]:
        require_same_schema(schema, landed_schema(spark, path, seq), f"landed batch {seq}")
    return batches(spark, path, seqs, schema)


def scan_landing(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all committed batches. Files that no batch committed are not read."""
    return scan_new_files(spark, path)
