"""Aggregate states that rows can be taken back from.

Sums and counts are kept with the number of values in them, so that a sum is NULL again when its last
value is taken back, and with the number of rows, so that a group disappears with its last row. An
extreme cannot be taken back; it holds for the part that wrote it and replaces earlier ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.states import MartSpec, counted_rows, mart_keys, partial

SIGN, ROWS = "_sign", "_rows"


def count_of(state: str) -> str:
    """The column with the number of values in a sum."""
    return f"{state}__n"


def lost(state: str) -> str:
    """The column with the extreme of the rows taken back."""
    return f"{state}__lost"


TAKE = {"max": F.max, "min": F.min}


def extremes(mart: MartSpec) -> list[tuple[str, str, str]]:
    """State, source column and kind (``max`` or ``min``) of the states that are no sums."""
    return [(m.name, m.extreme[1], m.extreme[0]) for m in mart.measures if m.extreme]


def signed(df: DataFrame, mart: MartSpec) -> DataFrame:
    """States per key of rows that are added (``SIGN`` 1) or taken back (-1); without ``SIGN`` all are added.

    Extremes are those of the added rows; with ``SIGN`` those of the rows taken back are beside them.
    """
    both = SIGN in df.columns
    rows = counted_rows(df if both else df.withColumn(SIGN, F.lit(1)), mart)
    kinds = {f.name: f.dataType for f in partial(df.drop(SIGN).limit(0), mart).schema.fields}

    def net(value: Column, kind: object) -> Column:
        gain, loss = (F.coalesce(F.sum(F.when(F.col(SIGN) == s, value)), F.lit(0)) for s in (1, -1))
        return (gain - loss).cast(kind)

    aggs = [F.sum(F.col(SIGN).cast("long")).alias(ROWS)]
    for measure in mart.measures:
        for state, value in measure.values.items():
            aggs.append(net(value(), kinds[state]).alias(state))
            aggs.append(F.sum(F.when(value().isNotNull(), F.col(SIGN).cast("long")).otherwise(F.lit(0).cast("long"))).alias(count_of(state)))
    for state, column, kind in extremes(mart):
        aggs.append(TAKE[kind](F.when(F.col(SIGN) == 1, F.col(column))).alias(state))
        if both:
            aggs.append(TAKE[kind](F.when(F.col(SIGN) == -1, F.col(column))).alias(lost(state)))
    return rows.groupBy(*mart_keys(mart)).agg(*aggs)


def balance(parts: DataFrame, mart: MartSpec, *kept: str, part: str = "part") -> DataFrame:
    """States of the rows that are left after all parts; groups without rows are gone."""
    aggs = [F.sum(ROWS).alias(ROWS)]
    for measure in mart.measures:
        for state in measure.partials:
            if state in measure.values:
                aggs.append(F.when(F.sum(count_of(state)) > 0, F.sum(state)).alias(state))
            else:
                aggs.append(F.max_by(state, part).alias(state))
    return parts.groupBy(*mart.keys, *kept).agg(*aggs).filter(F.col(ROWS) > 0).drop(ROWS)
