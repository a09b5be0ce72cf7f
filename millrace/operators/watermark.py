"""High-water-mark filter and fold."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.time import naive_utc


def mark_literal(value: datetime, dtype: T.DataType) -> Column:
    """A naive UTC mark as a literal of the column's own timestamp type, so filters push down."""
    if isinstance(dtype, T.TimestampType):
        return F.lit(value.isoformat(sep=" ") + "+00:00").cast(dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    raise TypeError(f"watermark column must be a timestamp, not {dtype.simpleString()}")


def newer_than(
    df: DataFrame, col: str, wm: datetime, key: str | None = None, wk: object | None = None
) -> Column:
    """``col > wm``, or with a key and a stored key also the ties ``col = wm AND key > wk``.

    The OR form is used because it is pushed to JDBC and Parquet; a struct comparison is not.
    """
    mark = mark_literal(wm, df.schema[col].dataType)
    if key is None or wk is None:
        return F.col(col) > mark
    key_mark = F.lit(wk).cast(df.schema[key].dataType)
    return (F.col(col) > mark) | ((F.col(col) == mark) & (F.col(key) > key_mark))


def scan_since(
    df: DataFrame,
    col: str,
    wm: datetime | None,
    key: str | None = None,
    wk: object | None = None,
) -> DataFrame:
    """Rows after the mark; all rows when there is no mark yet."""
    return df if wm is None else df.filter(newer_than(df, col, wm, key, wk))


def advance_watermark(
    df: DataFrame,
    col: str,
    key: str | None = None,
    prior: tuple[datetime, object | None] | None = None,
) -> DataFrame:
    """One row ``last_value, last_unique``: the greatest time, then the greatest key among its ties.

    Rows without a time are ignored, a missing key sorts lowest, and the mark never moves behind
    ``prior``. Only the two columns are read, and each task sends one row.
    """
    dtype = df.schema[col].dataType
    mark_literal(datetime(1970, 1, 1), dtype)
    time = naive_utc(F.col(col)) if isinstance(dtype, T.TimestampType) else F.col(col)
    key_type = df.schema[key].dataType if key else T.StringType()
    key_col = F.col(key) if key else F.lit(None).cast(key_type)
    pair = F.struct(time.alias("last_value"), key_col.alias("last_unique"))
    best = df.filter(F.col(col).isNotNull()).agg(F.max(pair).alias("m"))
    if prior is not None:
        value, unique = prior
        before = F.struct(
            mark_literal(value, T.TimestampNTZType()).alias("last_value"),
            F.lit(unique).cast(key_type).alias("last_unique"),
        )
        best = best.select(F.greatest("m", before).alias("m"))
    return best.select("m.last_value", "m.last_unique")
