"""Ratio and threshold expressions used by the dashboard panels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(num: Column, den: Column, digits: int) -> Column:
    """``num / den`` in percent, rounded half to even; NULL when ``den`` is zero."""
    return F.bround(num / F.nullif(den, F.lit(0)) * 100, digits)


def band(c: Column, warn: float, crit: float) -> Column:
    """Traffic-light colour of a value: strictly above ``crit`` red, above ``warn`` orange."""
    return (
        F.when(c > F.lit(crit), F.lit("red"))
        .when(c > F.lit(warn), F.lit("orange"))
        .otherwise(F.lit("green"))
    )
