"""Landed batches to table versions, as a run or as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.checks import require_same_schema
from millrace.operators.clean import clean
from millrace.operators.states import VERSION
from millrace.sources.files import commit
from millrace.sources.landing import SEQ, batches, landed, landed_rows, landed_schema
from millrace.sources.layout import Layout, clean_name
from millrace.sources.progress import (
    Intent,
    read_intent,
    read_intent_of,
    read_last_seq,
    read_record,
    write_intent,
    write_last_seq,
    write_record,
)
from millrace.sources.versioned import append_version, committed_versions
from millrace.streaming.commits import commit_stream, start


def _intent(spark: SparkSession, table: str, layout: Layout) -> Intent | None:
    """What this run has to do: a stopped run's intent, or all batches landed since the last one."""
    last = read_last_seq(spark, layout.state("transform", table))
    path = layout.state("intent", table)
    open_ = read_intent(spark, path)
    if open_ and (last is None or open_.seqs[-1] > last):
        return open_
    seqs = landed(spark, layout.landing(table), last)
    if not seqs:
        return None
    known = committed_versions(spark, layout.table(table))
    fresh = Intent(known[-1] + 1 if known else 0, seqs)
    write_intent(spark, path, fresh)
    return fresh


def run_transform(spark: SparkSession, table: str, layout: Layout) -> int:
    """Clean all batches landed since the last run as one batch and append it as the next table version.

    The batches and the version are written down first, so a run that stopped is repeated with the same
    ones: a version it had not committed is written again, one it had is only recorded. Only committed
    batches are read, and no older one is listed. Duplicates are dropped inside the version only. The
    record keeps the rows before and after cleaning. Returns the rows appended.
    """
    intent = _intent(spark, table, layout)
    return 0 if intent is None else _carry_out(spark, table, layout, intent)


def _carry_out(spark: SparkSession, table: str, layout: Layout, intent: Intent) -> int:
    """Write the version of an intent unless it is committed, and record it. Returns its rows."""
    landing, target = layout.landing(table), layout.table(table)
    if intent.version in committed_versions(spark, target):
        rows = commit(spark, target, VERSION, intent.version)["rows"]
    else:
        schema = landed_schema(spark, landing, intent.seqs[-1])
        for seq in intent.seqs[:-1]:
            require_same_schema(schema, landed_schema(spark, landing, seq), f"landed batch {seq}")
        rows = append_version(clean(batches(spark, landing, intent.seqs, schema)), target, intent.version)
    raw = landed_rows(spark, landing, intent.seqs)
    write_last_seq(spark, layout.state("transform", table), clean_name(table), intent, raw, rows)
    return rows


def _first_version(spark: SparkSession, table: str, layout: Layout) -> int:
    """The version of the stream's micro-batch 0, the same for the stream's whole life."""
    path = layout.state("stream_transform", table)
    found = read_record(spark, path, "first_version")
    if found is None:
        known = committed_versions(spark, layout.table(table))
        write_record(spark, path, 0, first_version=known[-1] + 1 if known else 0)
        found = read_record(spark, path, "first_version")
    return found[1]["first_version"]


def start_transform(
    spark: SparkSession,
    table: str,
    layout: Layout,
    most: int | None = None,
    written: Callable[[int, int], None] | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Start the stream that turns landed batches into table versions.

    The source are the commit records of the landing zone, so a torn batch waits until it is landed
    whole. A micro-batch (of at most ``most`` landed batches) becomes the version that follows from its
    own number; it is written once, whatever is repeated: the checkpoint gives a repeated micro-batch
    the same records, and a version that is committed is not written again. ``written`` is called with
    the version and its rows before the checkpoint moves. ``trigger`` is Spark's, by default all that is
    there (``availableNow``).

    Batches that a run had turned into versions before the stream began are left out. From then on the
    stream is the table's only writer; a version that another one has taken raises.
    """
    first = _first_version(spark, table, layout)
    state = layout.state("transform", table)

    def step(seqs: list[int], batch_id: int) -> None:
        version, last = first + batch_id, read_last_seq(spark, state)
        path = layout.state("intent", table)
        intent = read_intent_of(spark, path, version)
        if intent is None:
            if version in committed_versions(spark, layout.table(table)):
                raise RuntimeError(f"version {version} of {table} is not this stream's")
            fresh = [s for s in seqs if last is None or s > last]
            if not fresh:
                return
            intent = Intent(version, fresh)
            write_intent(spark, path, intent)
        elif not set(intent.seqs) <= set(seqs):
            raise RuntimeError(f"version {version} of {table} was begun by another writer, from batches {intent.seqs}")
        rows = _carry_out(spark, table, layout, intent)
        if written:
            written(version, rows)

    return start(commit_stream(spark, layout.landing(table), SEQ, most), f"{layout.state('stream_transform', table)}/checkpoint", step, **trigger)


def stream_transform(
    spark: SparkSession,
    table: str,
    layout: Layout,
    most: int | None = None,
    written: Callable[[int, int], None] | None = None,
) -> None:
    """Run ``start_transform`` over all that is landed, and end."""
    start_transform(spark, table, layout, most, written).awaitTermination()
