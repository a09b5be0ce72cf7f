"""Mergeable aggregate states: partial aggregates that are stored now and finished on read."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "_delta_version"


@dataclass(frozen=True)
class Measure:
    """One mart column: how rows become states, how states merge, and how the merge is read.

    ``partials`` maps a state column to its aggregate over rows, ``folds`` to the aggregate that
    merges two states, and ``finish`` computes the value from merged state columns. A state that is a
    sum has the summed value of a row in ``values``, so rows can be taken back; an extreme has its kind
    and column in ``extreme``.
    """

    name: str
    partials: dict[str, Callable[[], Column]]
    folds: dict[str, Callable[[str], Column]]
    finish: Callable[[], Column]
    values: dict[str, Callable[[], Column]]
    extreme: tuple[str, str] | None = None


def _single(name: str, build: Callable[[], Column], value: Callable[[], Column]) -> Measure:
    return Measure(name, {name: build}, {name: F.sum}, lambda: F.col(name), {name: value})


def _extreme(name: str, kind: str, take: Callable[[str], Column], column: str) -> Measure:
    return Measure(name, {name: lambda: take(column)}, {name: take}, lambda: F.col(name), {}, (kind, column))


def row_count(name: str) -> Measure:
    return _single(name, lambda: F.count(F.lit(1)), lambda: F.lit(1))


def total(name: str, value: Callable[[], Column]) -> Measure:
    """Sum that skips NULLs and is NULL for an all-NULL group."""
    return _single(name, lambda: F.sum(value()), value)


def highest(name: str, column: str) -> Measure:
    return _extreme(name, "max", F.max, column)


def lowest(name: str, column: str) -> Measure:
    return _extreme(name, "min", F.min, column)


def mean(name: str, column: str) -> Measure:
    """Average as double, kept as an exact sum and a count until it is read."""
    s, n = f"{name}_sum", f"{name}_n"
    return Measure(
        name,
        {s: lambda: F.sum(column), n: lambda: F.count(column)},
        {s: F.sum, n: F.sum},
        lambda: F.col(s).cast("double") / F.nullif(F.col(n), F.lit(0)),
        {s: lambda: F.col(column), n: lambda: F.col(column).isNotNull().cast("long")},
    )


@dataclass(frozen=True)
class MartSpec:
    """A mart: its source table, group keys, columns that must not be NULL, those it reads, measures.

    ``period`` names the time key, by whose months stored states are partitioned.
    """

    name: str
    source: str
    keys: dict[str, Callable[[], Column]]
    required: tuple[str, ...]
    reads: tuple[str, ...]
    measures: tuple[Measure, ...]
    period: str


def counted_rows(df: DataFrame, mart: MartSpec) -> DataFrame:
    """The rows a mart counts."""
    for c in mart.required:
        df = df.filter(F.col(c).isNotNull())
    return df


def mart_keys(mart: MartSpec) -> list[Column]:
    return [build().alias(name) for name, build in mart.keys.items()]


def partial(df: DataFrame, mart: MartSpec) -> DataFrame:
    """States per mart key, and per version when the rows carry one."""
    rows = counted_rows(df, mart)
    keys = mart_keys(mart)
    if VERSION in df.columns:
        keys.append(F.col(VERSION))
    aggs = [build().alias(s) for m in mart.measures for s, build in m.partials.items()]
    return rows.groupBy(*keys).agg(*aggs)


def finish(states: DataFrame, mart: MartSpec, by: Sequence[str] | None = None) -> DataFrame:
    """Values of fully merged states."""
    keys = list(mart.keys) if by is None else list(by)
    return states.select(*keys, *[m.finish().alias(m.name) for m in mart.measures])


def fold(states: DataFrame, mart: MartSpec, by: Sequence[str] | None = None) -> DataFrame:
    """States merged to the mart's keys, or rolled up to the coarser ``by``; still states."""
    keys = list(mart.keys) if by is None else list(by)
    return states.groupBy(*keys).agg(*[f(s).alias(s) for m in mart.measures for s, f in m.folds.items()])


def merge(states: DataFrame, mart: MartSpec, by: Sequence[str] | None = None) -> DataFrame:
    """Merge states to the mart's keys, or roll up to the coarser ``by``, and read their values."""
    return finish(fold(states, mart, by), mart, by)


def aggregate(df: DataFrame, mart: MartSpec) -> DataFrame:
    """Mart values straight from rows: one aggregate, no stored states."""
    return finish(partial(df.drop(VERSION), mart), mart)
