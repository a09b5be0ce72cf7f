"""Progress records: one small JSON file each, append-only, newest number wins."""

from __future__ import annotations

from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import SparkSession

from millrace.sources.files import exists, names_in, read_json, write_json


class Watermark(NamedTuple):
    seq: int
    value: datetime
    unique: str | None


class Intent(NamedTuple):
    """What a transform run set out to do: which landed batches become which version."""

    version: int
    seqs: list[int]


class Load(NamedTuple):
    table: str
    unique_key: str
    last_version: int
    rows: int


def record_path(path: str, number: int) -> str:
    return f"{path}/{number}.json"


def write_record(spark: SparkSession, path: str, number: int, **fields: object) -> None:
    """Add a record; ``updated_at`` is the time of the run in UTC.

    A record is never replaced: writing it again with the same fields changes nothing, with others raises
    ``FileExistsError``, as two writers then had the same number.
    """
    now = datetime.now(UTC).replace(tzinfo=None)
    try:
        write_json(spark, record_path(path, number), {**fields, "updated_at": now.isoformat(timespec="microseconds")})
    except FileExistsError:
        known = read_json(spark, record_path(path, number))
        if {k: v for k, v in known.items() if k != "updated_at"} != fields:
            raise


def read_record(spark: SparkSession, path: str, *needed: str) -> tuple[int, dict] | None:
    """Number and fields of the newest record, or ``None`` before the first."""
    names = [n.removesuffix(".json") for n in names_in(spark, path) if n.endswith(".json")]
    numbers = [int(n) for n in names if n.isdigit()]
    if not numbers:
        return None
    number = max(numbers)
    try:
        record = read_json(spark, record_path(path, number))
    except ValueError as e:
        raise ValueError(f"progress record {record_path(path, number)} is not a record") from e
    missing = [f for f in needed if record.get(f) is None]
    if missing:
        raise ValueError(f"progress record {record_path(path, number)} has no {', '.join(missing)}")
    return number, record


def read_watermark(spark: SparkSession, path: str) -> Watermark | None:
    """Newest extract mark, or ``None`` before the first run."""
    found = read_record(spark, path, "last_value")
    if found is None:
        return None
    seq, record = found
    try:
        value = datetime.fromisoformat(record["last_value"])
    except (TypeError, ValueError) as e:
        raise ValueError(f"progress record {record_path(path, seq)} has no valid last_value") from e
    return Watermark(seq, value, record.get("last_unique"))


def write_watermark(
    spark: SparkSession,
    path: str,
    seq: int,
    table: str,
    column: str,
    key: str | None,
    value: datetime | None,
    unique: object | None,
) -> None:
    """Record the mark after batch ``seq``; without a value nothing is written."""
    if value is not None:
        write_record(
            spark,
            path,
            seq,
            table=table,
            incremental_column=column,
            unique_column=key,
            last_value=value.isoformat(timespec="microseconds"),
            last_unique=None if unique is None else str(unique),
        )


def read_last_seq(spark: SparkSession, path: str) -> int | None:
    """Highest landed batch that became part of the table, or ``None`` before the first."""
    found = read_record(spark, path, "last_seq")
    return None if found is None else found[1]["last_seq"]


def write_last_seq(
    spark: SparkSession, path: str, table: str, intent: Intent, raw_rows: int, clean_rows: int
) -> None:
    """Record that an intent is done: its batches are in the table, with this many rows before and after."""
    write_record(
        spark,
        path,
        intent.seqs[-1],
        table=table,
        last_seq=intent.seqs[-1],
        seqs=intent.seqs,
        version=intent.version,
        raw_rows=raw_rows,
        clean_rows=clean_rows,
    )


def read_intent(spark: SparkSession, path: str) -> Intent | None:
    found = read_record(spark, path, "version", "seqs")
    return None if found is None else Intent(found[1]["version"], found[1]["seqs"])


def read_intent_of(spark: SparkSession, path: str, version: int) -> Intent | None:
    """What became of a version, or ``None`` for one that no run set out to write."""
    if not exists(spark, record_path(path, version)):
        return None
    return Intent(version, read_json(spark, record_path(path, version))["seqs"])


def write_intent(spark: SparkSession, path: str, intent: Intent) -> None:
    write_record(spark, path, intent.version, version=intent.version, seqs=intent.seqs)


def read_progress(spark: SparkSession, path: str) -> Load | None:
    """Newest load record, or ``None`` before the first load."""
    found = read_record(spark, path, "last_version")
    if found is None:
        return None
    record = found[1]
    return Load(record["table"], record["unique_key"], record["last_version"], record["rows"])


def write_progress(
    spark: SparkSession, path: str, table: str, unique_key: str, last_version: int, rows: int
) -> None:
    """Record that versions up to ``last_version`` are loaded."""
    write_record(
        spark, path, last_version, table=table, unique_key=unique_key, last_version=last_version, rows=rows
    )
