"""The three chained stages: extract, transform, load."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from threading import Event
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.checks import require_columns
from millrace.operators.clean import to_naive_utc
from millrace.operators.states import VERSION
from millrace.operators.watermark import advance_watermark, scan_since
from millrace.plans.contracts import CONTRACTS, conform
from millrace.plans.marts import refresh_marts
from millrace.sources.files import commit
from millrace.sources.landing import batches, land, landed, landed_schema
from millrace.sources.layout import Layout, clean_name
from millrace.sources.progress import (
    Watermark,
    read_progress,
    read_watermark,
    write_progress,
    write_watermark,
)
from millrace.sources.relation import JdbcSink, TableSpec, source_relation, windowed_jdbc, write_jdbc
from millrace.sources.versioned import (
    append_version,
    committed_versions,
    current_version,
    read_versions,
)
from millrace.streaming.commits import commit_stream, start
from millrace.streaming.ingest import run_transform

# Fixed value: the column that marks when a source row last changed.
UPDATED_AT = "updated_at"

S = TypeVar("S")


def _key(spec: TableSpec) -> str | None:
    """The tie-break key: as configured, else the contract's."""
    contract = CONTRACTS.get(clean_name(spec.name))
    return spec.unique_column or (contract.key if contract else None)


def _advance(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    prior: Watermark | None,
    seqs: list[int],
) -> Watermark | None:
    """Fold the mark from the landed rows themselves, so it never covers a row that was not landed."""
    key = _key(spec)
    landing = layout.landing(spec.name)
    rows = batches(spark, landing, seqs, landed_schema(spark, landing, seqs[-1]))
    before = (prior.value, prior.unique) if prior else None
    value, unique = advance_watermark(rows, UPDATED_AT, key, before).first()
    state = layout.state("extract", spec.name)
    write_watermark(spark, state, seqs[-1], spec.name, UPDATED_AT, key, value, unique)
    return None if value is None else Watermark(seqs[-1], value, None if unique is None else str(unique))


def run_extract(spark: SparkSession, spec: TableSpec, layout: Layout) -> int:
    """Land the source rows after the stored mark, then move the mark. Returns the rows landed.

    Batches landed by a run that stopped before it recorded its mark are taken into account first
    and never rewritten, since a reader may have seen them.
    """
    key, landing = _key(spec), layout.landing(spec.name)
    mark = read_watermark(spark, layout.state("extract", spec.name))
    unrecorded = landed(spark, landing, mark.seq if mark else None)
    if unrecorded:
        mark = _advance(spark, spec, layout, mark, unrecorded)
    seq = max([mark.seq if mark else -1, *unrecorded]) + 1

    since = mark.value if mark else None
    source = windowed_jdbc(spark, spec, UPDATED_AT, since) if spec.jdbc else source_relation(spark, spec)
    require_columns(source, UPDATED_AT, key)
    dtype = source.schema[UPDATED_AT].dataType
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{UPDATED_AT} of {spec.name} must be a timestamp, not {dtype.simpleString()}")
    fresh = scan_since(source, UPDATED_AT, since, key, mark.unique if mark else None)
    if mark and not spec.jdbc:
        # The few new rows of a large table may come from every one of its files. Gathering them by key
        # lands few files of good size; a first, full run has such files already and is not shuffled.
        fresh = fresh.hint("rebalance", F.col(key or UPDATED_AT))
    rows = land(fresh, landing, seq)
    if rows:
        _advance(spark, spec, layout, mark, [seq])
    return rows


def load_versions(
    spark: SparkSession,
    layout: Layout,
    table: str,
    last_version: int | None,
    upto: int,
    sink: JdbcSink | None = None,
) -> int:
    """Copy the table versions in ``last_version < v <= upto`` into the warehouse under its contract.

    One version is one job into its own directory, which keeps the file order the cleaning step gave
    its rows; several run side by side. A version that is committed already is not written again, so a
    retry takes nothing away from readers. With a ``sink`` the versions written by this run also go to
    a table of an external database. Returns the rows loaded.
    """
    name = clean_name(table)
    source, target = layout.table(name), layout.warehouse(name)
    done = set(committed_versions(spark, target))

    def load(v: int) -> int:
        if v in done:
            return commit(spark, target, VERSION, v)["rows"]
        rows = conform(to_naive_utc(read_versions(spark, source, [v])), name)
        if sink:
            write_jdbc(rows, sink, name)
        return append_version(rows, target, v)

    wanted = [v for v in committed_versions(spark, source, last_version) if v <= upto]
    return sum(run_stage(load, wanted[:1])) + sum(run_stage(load, wanted[1:], parallel=4))


def run_load(spark: SparkSession, table: str, layout: Layout, sink: JdbcSink | None = None) -> int:
    """Load new table versions, refresh the marts they feed, then record progress."""
    name = clean_name(table)
    current = current_version(spark, layout.table(name))
    if current is None:
        raise FileNotFoundError(f"table {name} has no version to load")
    state = layout.state("load", name)
    progress = read_progress(spark, state)
    last = progress.last_version if progress else None
    if last is not None and current <= last:
        return 0
    rows = load_versions(spark, layout, name, last, current, sink)
    refresh_marts(spark, layout, name)
    write_progress(spark, state, name, CONTRACTS[name].key, current, rows)
    return rows


def start_load(
    spark: SparkSession,
    table: str,
    layout: Layout,
    most: int | None = None,
    loaded: Callable[[int], None] | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Start the stream that loads table versions and feeds the marts.

    The source are the commit records of the table's versions; the checkpoint holds what was handled,
    ``most`` versions at a time. A micro-batch loads every version up to its newest that is not loaded
    yet, refreshes the marts and records progress. Each of these finds what a stopped run has done
    and does the rest, so a repeated micro-batch changes nothing. ``loaded`` is called with the newest
    version before the checkpoint moves. Progress is shared with ``run_load``.
    """
    name = clean_name(table)
    state = layout.state("load", name)

    def step(versions: list[int], _: int) -> None:
        progress = read_progress(spark, state)
        last = progress.last_version if progress else None
        if last is None or versions[-1] > last:
            rows = load_versions(spark, layout, name, last, versions[-1])
            refresh_marts(spark, layout, name)
            write_progress(spark, state, name, CONTRACTS[name].key, versions[-1], rows)
        if loaded:
            loaded(versions[-1])

    records = commit_stream(spark, layout.table(name), VERSION, most)
    return start(records, f"{layout.state('stream_load', name)}/checkpoint", step, **trigger)


def stream_load(
    spark: SparkSession,
    table: str,
    layout: Layout,
    most: int | None = None,
    loaded: Callable[[int], None] | None = None,
) -> None:
    """Run ``start_load`` over all committed versions, and end."""
    start_load(spark, table, layout, most, loaded).awaitTermination()


def run_stage(stage: Callable[[S], int], tables: Iterable[S], parallel: int = 1) -> list[int]:
    """Run one stage over its tables, ``parallel`` at a time; the results keep the list's order.

    Tables do not depend on each other, so small ones use executors that a large one leaves idle. After
    a failure no further table is started; it is raised once the running ones have ended.
    """
    failed = Event()

    def run(table: S) -> int:
        if failed.is_set():
            return 0
        try:
            return stage(table)
        except BaseException:
            failed.set()
            raise

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return [f.result() for f in [pool.submit(run, t) for t in tables]]


def check_specs(specs: list[TableSpec]) -> None:
    """Reject tables that would share a folder: named twice, or alike but for dots and schemas."""
    layout = Layout("")
    owners: dict[str, str] = {}
    for i, spec in enumerate(specs):
        for path in layout.paths_of(spec.name):
            if path in owners:
                raise ValueError(f"tables {owners[path]} and {spec.name} share the folder {path}")
        owners |= dict.fromkeys(layout.paths_of(spec.name), f"{spec.name} ({i})")


def run_pipeline(
    spark: SparkSession, specs: list[TableSpec], layout: Layout, parallel: int = 4
) -> dict[str, list[int]]:
    """Extract, transform and load in turn; a stage starts only when the one before succeeded.

    A table for which nothing was ever landed has no version and is left out of the load. Returns
    rows per stage and table.
    """
    check_specs(specs)
    names = [s.name for s in specs]
    done = {
        "extract": run_stage(lambda s: run_extract(spark, s, layout), specs, parallel),
        "transform": run_stage(lambda n: run_transform(spark, n, layout), names, parallel),
    }
    filled = [n for n in names if current_version(spark, layout.table(n)) is not None]
    done["load"] = run_stage(lambda n: run_load(spark, n, layout), filled, parallel)
    return done
