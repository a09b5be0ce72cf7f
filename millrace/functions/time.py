"""Timestamp expressions whose value does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros_to_ntz(micros: Column) -> Column:
    """Microseconds since the epoch as a naive UTC timestamp.

    A plain integer cast would read the number as seconds.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, epoch)


def naive_utc(instant: Column) -> Column:
    """UTC wall time of a zoned timestamp.

    ``cast("timestamp_ntz")`` would give the wall time of the session zone, and going through it
    loses the hour that repeats when clocks go back; counting microseconds does neither.
    """
    return micros_to_ntz(F.unix_micros(instant))


def start_of_hour(c: Column) -> Column:
    """Start of the hour of a naive timestamp.

    ``date_trunc`` returns a zoned timestamp, so it is avoided here.
    """
    return F.timestamp_add("HOUR", F.hour(c), F.to_date(c).cast("timestamp_ntz"))
