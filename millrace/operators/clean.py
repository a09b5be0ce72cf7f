"""Batch cleaning: time casts, exact-duplicate removal and a deterministic order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.time import micros_to_ntz, naive_utc

# Name parts that mark a time column, and the names that order a batch.
TIME_NAME_PARTS = ("timestamp", "created_at", "updated_at")
SORT_NAMES = ("id", "updated_at", "created_at", "timestamp")
SORT_SUFFIX = "_id"


# Anything after a time of day but digits, colons and points: a zone.
ZONED = r"[0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]*)?)?\s*[^0-9:.\s].*$"


def parse_time(text: Column, name: str) -> Column:
    """Text as a naive timestamp: zoned text as UTC, text without zone as it stands.

    Text that is no timestamp raises, under any session setting.
    """
    value = F.when(text.rlike(ZONED), naive_utc(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))
    problem = F.raise_error(F.concat(F.lit(f"no timestamp in {name}: "), text)).cast("timestamp_ntz")
    return F.when(text.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(F.coalesce(value, problem))


def _as_datetime(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(field.dataType, T.IntegralType):
        return micros_to_ntz(c).alias(field.name)
    if isinstance(field.dataType, T.DateType):
        return c.cast("timestamp_ntz").alias(field.name)
    return parse_time(c.cast("string"), field.name).alias(field.name)


def cast_time_columns(df: DataFrame) -> DataFrame:
    """Turn every time-named column into a microsecond timestamp; integers count microseconds."""
    return df.select(
        *[
            _as_datetime(f)
            if any(part in f.name.lower() for part in TIME_NAME_PARTS)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def to_naive_utc(df: DataFrame) -> DataFrame:
    """Replace every zoned timestamp by its UTC wall time."""
    return df.select(
        *[
            naive_utc(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each group of identical rows; NULLs count as equal.

    Copies collapse in the map-side aggregate, so a group holding most of the batch never travels.
    """
    return df.dropDuplicates()


def sort_columns(df: DataFrame) -> list[str]:
    """Columns that order a batch, in schema order; names are case-sensitive."""
    return [c for c in df.columns if c in SORT_NAMES or c.endswith(SORT_SUFFIX)]


def deterministic_sort(df: DataFrame) -> DataFrame:
    """Range-partition and sort by ``sort_columns``, NULLs first.

    A hash of the row breaks ties, so rows that share one sort key can still be split over tasks.
    """
    cols = sort_columns(df)
    if not cols:
        return df
    order = [F.col(f"`{c}`").asc_nulls_first() for c in cols]
    order.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).asc())
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def clean(df: DataFrame) -> DataFrame:
    """The whole cleaning step for one batch."""
    return deterministic_sort(drop_exact_duplicates(cast_time_columns(df)))
