"""The four marts: their specifications, backfill, incremental refresh and read side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.time import start_of_hour
from millrace.operators.latest import latest_by_key
from millrace.operators.retraction import SIGN, balance, extremes, signed
from millrace.operators.states import (
    VERSION,
    MartSpec,
    fold,
    highest,
    lowest,
    mean,
    merge,
    partial,
    row_count,
    total,
)
from millrace.plans.contracts import CONTRACTS
from millrace.plans.newest import append_index, newest_rows, read_index, replaced_rows, start_index, with_extremes
from millrace.sources.files import ATTEMPT, commit, committed, data_dirs, write_numbered
from millrace.sources.layout import Layout
from millrace.sources.progress import read_record, write_record
from millrace.sources.versioned import added_since, as_of, committed_versions, current_version

ORDERS = "fact_production_orders"
READINGS = "fact_sensor_readings"


def _order_date():
    return F.to_date("start_time")


def _gap():
    return F.col("target_qty").cast("long") - F.col("actual_qty").cast("long")


def _flag():
    return F.col("is_anomaly").cast("int")


MARTS: dict[str, MartSpec] = {
    m.name: m
    for m in (
        MartSpec(
            "mv_production_daily",
            ORDERS,
            keys={"order_date": _order_date},
            required=("start_time",),
            reads=("start_time", "target_qty", "actual_qty"),
            measures=(
                row_count("order_count"),
                total("target_total", lambda: F.col("target_qty")),
                total("actual_total", lambda: F.col("actual_qty")),
                total("gap_total", _gap),
            ),
            period="order_date",
        ),
        MartSpec(
            "mv_machine_daily",
            ORDERS,
            keys={"machine_id": lambda: F.col("machine_id"), "order_date": _order_date},
            required=("machine_id", "start_time"),
            reads=("machine_id", "start_time", "target_qty", "actual_qty"),
            measures=(
                row_count("order_count"),
                total("target_total", lambda: F.col("target_qty")),
                total("actual_total", lambda: F.col("actual_qty")),
            ),
            period="order_date",
        ),
        MartSpec(
            "mv_sensor_hourly",
            READINGS,
            keys={
                "sensor_id": lambda: F.col("sensor_id"),
                "reading_hour": lambda: start_of_hour(F.col("reading_timestamp")),
            },
            required=("sensor_id",),
            reads=("sensor_id", "reading_timestamp", "reading_value", "is_anomaly"),
            measures=(
                mean("avg_val", "reading_value"),
                highest("max_val", "reading_value"),
                lowest("min_val", "reading_value"),
                row_count("readings"),
                total("anomaly_count", _flag),
            ),
            period="reading_hour",
        ),
        MartSpec(
            "mv_anomaly_daily",
            READINGS,
            keys={"reading_date": lambda: F.to_date("reading_timestamp")},
            required=(),
            reads=("reading_timestamp", "is_anomaly"),
            measures=(total("anomaly_count", _flag), row_count("total_readings")),
            period="reading_date",
        ),
    )
}


def marts_of(table: str) -> list[str]:
    """Marts fed by a warehouse table; dimensions feed none."""
    return [m.name for m in MARTS.values() if m.source == table]


def read_table(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """Every loaded row version of a warehouse table, under its contract."""
    return as_of(spark, layout.warehouse(name), schema=CONTRACTS[name].schema)


def latest_table(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """Newest row per key of a warehouse table."""
    return latest_by_key(read_table(spark, layout, name), [CONTRACTS[name].key])


# A mart is a row of builds; the newest record names the one in use. A build is a row of parts, each
# with the states of the table versions after the part before, up to ``upto`` of its commit record.
PART = "part"
MODES = ("append", "latest")
# Stored states lie in one folder per month of their time key, so a panel reads the months it shows.
MONTH = "_month"


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def _state_schema(spark: SparkSession, mart: MartSpec, mode: str) -> T.StructType:
    fields = CONTRACTS[mart.source].schema.fields
    empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return (partial if mode == "append" else signed)(empty.drop(VERSION), mart).schema


def _builds(layout: Layout, name: str, mode: str) -> str:
    return layout.state(f"marts_{mode}", name)


def current_build(spark: SparkSession, layout: Layout, name: str, mode: str = "append") -> int | None:
    """Number of the build in use, or ``None`` for a mart that was never built."""
    found = read_record(spark, _builds(layout, name, mode), "build")
    return None if found is None else found[1]["build"]


def mart_upto(spark: SparkSession, layout: Layout, name: str, mode: str = "append") -> int | None:
    """Newest table version that the mart in use covers."""
    build = current_build(spark, layout, name, mode)
    if build is None:
        return None
    path = layout.mart(name, mode, build)
    parts = committed(spark, path, PART)
    return commit(spark, path, PART, parts[-1])["upto"] if parts else None


def _write_part(states: DataFrame, mart: MartSpec, path: str, part: int, upto: int) -> None:
    # Rebalancing gathers few states into few files and splits what is large.
    states = states.withColumn(MONTH, month_of(F.col(mart.period))).hint("rebalance", F.col(MONTH))
    write_numbered(states, path, PART, part, empty=True, by=[MONTH], upto=upto)


def _read_parts(spark: SparkSession, path: str, parts: list[int], schema: T.StructType) -> DataFrame:
    """Rows of committed parts, with their number and month."""
    full = T.StructType([*schema.fields, T.StructField(PART, T.IntegerType()), T.StructField(MONTH, T.StringType())])
    return spark.read.schema(full).option("basePath", path).parquet(*data_dirs(spark, path, PART, parts)).drop(ATTEMPT)


def _mart_rows(df: DataFrame, mart: MartSpec) -> DataFrame:
    """The columns a mart reads, with what decides which row of a key is newest."""
    keep = {CONTRACTS[mart.source].key, VERSION, "updated_at", *mart.reads}
    return df.select(*[c for c in df.columns if c in keep])


def build_mart(
    spark: SparkSession,
    layout: Layout,
    name: str,
    mode: str = "append",
    replace: bool = False,
) -> None:
    """Fill a mart from the whole history of its table.

    ``append`` counts every row version, as a mart fed by inserts does; ``latest`` counts the newest
    row per key only, ties broken on the columns the mart reads. An existing mart must be rebuilt
    explicitly with ``replace``. The new build is written beside the one in use, which readers see
    until the new one is whole and recorded.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mart mode {mode!r}")
    mart = MARTS[name]
    build = current_build(spark, layout, name, mode)
    if build is not None and not replace:
        raise FileExistsError(f"mart {name} exists; pass replace=True to rebuild it")
    upto = current_version(spark, layout.warehouse(mart.source))
    rows = as_of(spark, layout.warehouse(mart.source), upto, CONTRACTS[mart.source].schema)
    fresh = _fresh_build(spark, layout, name, mode, build)
    path = layout.mart(name, mode, fresh)
    if mode == "latest":
        known = committed_versions(spark, layout.warehouse(mart.source))
        total_rows = sum(commit(spark, layout.warehouse(mart.source), VERSION, v)["rows"] for v in known)
        newest = latest_by_key(_mart_rows(rows, mart), [CONTRACTS[mart.source].key])
        start_index(newest, mart, index_path(path), total_rows, upto)
        states = signed(read_index(spark, mart, index_path(path), [0]), mart)
    else:
        states = partial(rows.drop(VERSION), mart)
    _switch(spark, layout, name, mode, fresh, states, upto)


def index_path(path: str) -> str:
    return f"{path}/newest"


def _fresh_build(spark: SparkSession, layout: Layout, name: str, mode: str, build: int | None) -> int:
    """The next build number. What a stopped run committed but did not record is left behind, unused."""
    fresh = 0 if build is None else build + 1
    while any(committed(spark, p, PART) for p in (layout.mart(name, mode, fresh), index_path(layout.mart(name, mode, fresh)))):
        fresh += 1
    return fresh


def _switch(
    spark: SparkSession, layout: Layout, name: str, mode: str, fresh: int, states: DataFrame, upto: int
) -> None:
    """Write a build of one part and put it in use."""
    _write_part(states, MARTS[name], layout.mart(name, mode, fresh), 0, upto)
    write_record(spark, _builds(layout, name, mode), fresh, mart=name, mode=mode, build=fresh)


def refresh_mart(spark: SparkSession, layout: Layout, name: str, mode: str = "append") -> None:
    """Bring a mart up to its table's newest version.

    An ``append`` mart adds one part with the states of the versions after its own last one, however
    many they are. A ``latest`` mart adds one part with what the new versions change: the rows they
    replace are taken back, their own are added. A mart that has no build yet starts with the whole
    history. Nothing new is no work.
    """
    mart = MARTS[name]
    current, upto = current_version(spark, layout.warehouse(mart.source)), mart_upto(spark, layout, name, mode)
    if current is None or upto == current:
        return
    if upto is None:
        build_mart(spark, layout, name, mode, replace=True)
        return
    path = layout.mart(name, mode, current_build(spark, layout, name, mode))
    part = committed(spark, path, PART)[-1] + 1
    if mode == "latest":
        _retract(spark, layout, mart, path, part, upto, current)
        return
    rows = added_since(
        spark, layout.warehouse(mart.source), upto, current, schema=CONTRACTS[mart.source].schema
    )
    _write_part(partial(rows.drop(VERSION), mart), mart, path, part, current)


def _retract(
    spark: SparkSession, layout: Layout, mart: MartSpec, path: str, part: int, upto: int, current: int
) -> None:
    """Add the part of a ``latest`` mart that turns the newest rows up to ``upto`` into those up to ``current``.

    The newest rows of the new versions go into the index first. An index part whose states a stopped
    run did not write tells how far it went: it is finished, and then what came since.
    """
    index, key = index_path(path), CONTRACTS[mart.source].key
    if part in committed(spark, index, PART):
        upto_now = commit(spark, index, PART, part)["upto"]
    else:
        upto_now = current
        rows = added_since(spark, layout.warehouse(mart.source), upto, current, schema=CONTRACTS[mart.source].schema)
        append_index(latest_by_key(_mart_rows(rows, mart), [key]), mart, index, part, current)
    fresh, former = replaced_rows(spark, mart, index, part)
    delta = signed(fresh.withColumn(SIGN, F.lit(1)).unionByName(former.withColumn(SIGN, F.lit(-1))), mart)
    if extremes(mart):
        months = [r[0] for r in delta.select(month_of(F.col(mart.period))).distinct().collect()]
        earlier = _read_parts(spark, path, [p for p in committed(spark, path, PART) if p < part], delta.schema)
        in_months = F.coalesce(F.col(MONTH).isin([m for m in months if m is not None]), F.lit(False))
        if None in months:
            in_months |= F.col(MONTH).isNull()
        delta = with_extremes(delta, earlier.filter(in_months), index, mart, part)
    _write_part(delta, mart, path, part, upto_now)
    if upto_now != current:
        _retract(spark, layout, mart, path, part + 1, upto_now, current)


def refresh_marts(spark: SparkSession, layout: Layout, table: str) -> None:
    """Refresh every mart of a table; ``latest`` marts only where they were built."""
    for name in marts_of(table):
        refresh_mart(spark, layout, name)
        if current_build(spark, layout, name, "latest") is not None:
            refresh_mart(spark, layout, name, "latest")


def fold_mart(spark: SparkSession, layout: Layout, name: str, mode: str = "append") -> None:
    """Merge the parts of a mart into a new build of one part.

    Panels list and merge every part of the months they show, so their cost follows the number of loads
    until they are folded. The index of a ``latest`` mart is folded with it: rows that later ones
    replaced are dropped.
    """
    mart = MARTS[name]
    build, upto = current_build(spark, layout, name, mode), mart_upto(spark, layout, name, mode)
    if build is None or len(parts := committed(spark, layout.mart(name, mode, build), PART)) < 2:
        return
    old, fresh = layout.mart(name, mode, build), _fresh_build(spark, layout, name, mode, build)
    path = layout.mart(name, mode, fresh)
    if mode == "append":
        states = fold(read_states(spark, layout, name), mart)
    else:
        # Parts above the last committed one belong to a stopped refresh, which starts anew on the fold.
        index = index_path(old)
        rows = sum(commit(spark, index, PART, p)["rows"] for p in parts)
        newest = newest_rows(read_index(spark, mart, index, parts), CONTRACTS[mart.source].key)
        start_index(newest, mart, index_path(path), rows, upto)
        states = signed(read_index(spark, mart, index_path(path), [0]), mart)
    _switch(spark, layout, name, mode, fresh, states, upto)


def read_states(spark: SparkSession, layout: Layout, name: str, mode: str = "append") -> DataFrame:
    """Stored states of a mart: the committed parts of the build in use.

    One row per key and part, or per key for ``latest``, where parts add to and take from each other.
    The month of the time key is a column, on whose folders filters are evaluated.
    """
    build = current_build(spark, layout, name, mode)
    if build is None:
        raise FileNotFoundError(f"mart {name} was never built")
    mart, path = MARTS[name], layout.mart(name, mode, build)
    parts = _read_parts(spark, path, committed(spark, path, PART), _state_schema(spark, mart, mode))
    if mode == "append":
        return parts.drop(PART)
    states = _state_schema(spark, mart, "append")
    return balance(parts, mart, MONTH).select(*[F.col(f.name).cast(f.dataType) for f in states.fields], MONTH)


def read_mart(spark: SparkSession, layout: Layout, name: str, mode: str = "append") -> DataFrame:
    """Merged content of a mart."""
    return merge(read_states(spark, layout, name, mode), MARTS[name])
