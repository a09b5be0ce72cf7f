"""Source relations: a catalog table or view, a SELECT, or a JDBC table."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.time import micros_to_ntz

# Fixed value: rows per fetch.
FETCH_SIZE = 100_000
# Fixed value: rows per insert batch.
BATCH_SIZE = 100_000
LOOK_BACK = timedelta(days=1)


@dataclass(frozen=True)
class JdbcSource:
    """Connection options of ``spark.read.format("jdbc")`` and how to split the read.

    The read is cut into ``num_partitions`` ranges of ``partition_column``, by default the watermark
    column; there is no default for their number, since one range is one task and one connection for
    the whole table. Where very many rows share one timestamp, name a numeric key instead.
    """

    options: dict[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    num_partitions: int = 0

    def __post_init__(self):
        if self.num_partitions < 1:
            raise ValueError("say in how many partitions a JDBC table is read (1 for a small one)")


@dataclass(frozen=True)
class JdbcSink:
    """Connection options of ``df.write.format("jdbc")``; each task writes over its own connection."""

    options: dict[str, str] = field(default_factory=dict)
    num_partitions: int = 8
    schema: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """One source table: its name, the key that breaks watermark ties, and an optional SELECT."""

    name: str
    unique_column: str | None = None
    query: str | None = None
    jdbc: JdbcSource | None = None


def quoted(name: str) -> str:
    """Each part of a dotted name in double quotes, which databases take as it is."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def select_text(spec: TableSpec) -> str:
    if spec.query:
        return spec.query.strip().rstrip(";").rstrip()
    return f"SELECT * FROM {quoted(spec.name) if spec.jdbc else spec.name}"


def _derived(text: str) -> str:
    return f"({text}) AS src"


def _jdbc(spark: SparkSession, jdbc: JdbcSource, dbtable: str, **extra: object) -> DataFrame:
    defaults = {"fetchsize": FETCH_SIZE, "preferTimestampNTZ": "true"}
    options = {**defaults, **jdbc.options, "dbtable": dbtable, **extra}
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, sink: JdbcSink, table: str) -> None:
    """Append rows to a database table in batches.

    A task that is repeated after a lost executor inserts its rows again, and so does a load that
    stopped before it committed: give the table a key that ignores repeats, or merge on read.
    """
    name = quoted(f"{sink.schema}.{table}" if sink.schema else table)
    options = {"batchsize": BATCH_SIZE, "numPartitions": sink.num_partitions, **sink.options, "dbtable": name}
    df.write.format("jdbc").options(**options).mode("append").save()


def scan_full(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The whole source table, unfiltered and unordered."""
    if spec.jdbc:
        return _jdbc(spark, spec.jdbc, quoted(spec.name))
    return spark.table(spec.name)


def scan_query(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The rows of a user-supplied SELECT; a trailing semicolon is dropped."""
    if spec.jdbc:
        return _jdbc(spark, spec.jdbc, _derived(select_text(spec)))
    return spark.sql(select_text(spec))


def source_relation(spark: SparkSession, spec: TableSpec) -> DataFrame:
    return scan_query(spark, spec) if spec.query else scan_full(spark, spec)


def bounds_text(spec: TableSpec, column: str, since: datetime | None) -> str:
    """One-row SELECT, run by the database, of the window end and the range to split.

    It looks back a day past ``since``: a database compares the literal in its own session zone when
    the column is zoned, and rows that are not new do no harm here.
    """
    split = quoted(spec.jdbc.partition_column or column)
    column, where = quoted(column), ""
    if since is not None:
        where = f" WHERE {column} >= TIMESTAMP '{(since - LOOK_BACK).isoformat(sep=' ')}'"
    return (
        f"SELECT max({column}) AS hi, min({split}) AS split_lo, max({split}) AS split_hi "
        f"FROM ({select_text(spec)}) AS src{where}"
    )


def split_options(jdbc: JdbcSource, column: str, lo: object, hi: object) -> dict[str, object]:
    if jdbc.num_partitions <= 1 or lo is None:
        return {}
    return {
        "partitionColumn": jdbc.partition_column or column,
        "lowerBound": lo,
        "upperBound": hi,
        "numPartitions": jdbc.num_partitions,
    }


def windowed_jdbc(spark: SparkSession, spec: TableSpec, column: str, since: datetime | None) -> DataFrame:
    """A JDBC relation closed at the newest ``column`` value seen before the read starts.

    Its partitions use several connections and so see the moving table at different moments. A row
    changed meanwhile gets a time past the window end and is left to the next run, instead of pushing
    the mark past rows another connection had not read yet. Rows without a time belong to the first
    run only.
    """
    bounds = _jdbc(spark, spec.jdbc, _derived(bounds_text(spec, column, since)))
    lo, up, hi = bounds.select(
        F.col("split_lo").cast("string"),
        F.col("split_hi").cast("string"),
        _micros(bounds, "hi"),
    ).first()
    naive = isinstance(bounds.schema["hi"].dataType, T.TimestampNTZType)
    by_time = spec.jdbc.partition_column in (None, column)
    if since is not None and by_time and naive and hi is not None and hi >= _python_micros(since):
        lo = since.isoformat(sep=" ")
    dbtable = _derived(select_text(spec))
    df = _jdbc(spark, spec.jdbc, dbtable, **split_options(spec.jdbc, column, lo, up))
    if hi is None:
        return df if since is None else df.limit(0)
    end = F.timestamp_micros(F.lit(hi))
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        end = micros_to_ntz(F.lit(hi))
    inside = F.col(column) <= end
    return df.filter(inside | F.col(column).isNull()) if since is None else df.filter(inside)


def _python_micros(value: datetime) -> int:
    return (value - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def _micros(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, c)
    return F.unix_micros(c)
