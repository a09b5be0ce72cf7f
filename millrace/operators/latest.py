"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    version: str = "_delta_version",
    tie: Sequence[str] = ("updated_at",),
) -> DataFrame:
    """Keep the row with the highest ``version`` per key, then the highest ``tie`` columns.

    A hash of the whole row decides between rows that still tie, so the answer does not depend on task
    order; name columns in ``tie`` where it must follow from their values.
    The rank filter also runs before the shuffle, where a task passes on one row per key; a key with
    very many versions therefore reaches its reducer as one row per map task.
    """
    named = [version, *[c for c in tie if c in df.columns]]
    order = [F.col(c).desc_nulls_last() for c in named]
    order.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
