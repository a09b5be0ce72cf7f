"""Numbered output directories on any Hadoop file system.

Every batch, version and mart part is one directory ``{label}={n}``. It counts from the moment its
commit record ``_committed/{label}={n}`` exists, which is written after the data and never again: the
record holds the rows, the schema and the time (UTC), so readers open no footer to learn them. What has no record is
seen by no reader and goes when a retry commits; what has one is never touched.

Each attempt at a number writes a folder of its own inside the directory, and the record names the one
that counts. The record is created only where there is none, so of two writers of one number one
commits and the other raises, and neither touches the other's files before that.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkRuntimeError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMITS, ATTEMPT = "_committed", "_attempt"
# Commit records read side by side.
READERS = 16


def _fs(spark: SparkSession, path: str):
    if not hasattr(spark, "_jvm"):
        raise PySparkRuntimeError("numbered directories need a classic (non-Connect) session")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where there is no folder."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def write_json(spark: SparkSession, path: str, record: dict) -> None:
    """Create a small record whole or not at all; ``FileExistsError`` where there is one. No Spark job runs."""
    fs, target = _fs(spark, path)
    _, beside = _fs(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    out = fs.create(beside)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    try:
        (_link if fs.getScheme() == "file" else _rename)(spark, beside, target)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise FileExistsError(f"{path} is there already") from e
        raise
    finally:
        fs.delete(beside, False)


def _link(spark: SparkSession, source, target) -> None:
    """A second name for a local file; the system refuses a name in use."""
    at = spark._jvm.java.nio.file.Paths.get
    spark._jvm.java.nio.file.Files.createLink(at(target.toUri().getPath(), _strings(spark)), at(source.toUri().getPath(), _strings(spark)))


def _rename(spark: SparkSession, source, target) -> None:
    """Rename unless the new name is in use: one step on file systems whose rename is, as HDFS."""
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, context.makeQualified(target), options)


def _strings(spark: SparkSession):
    return spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)


def read_json(spark: SparkSession, path: str) -> dict:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    record = json.loads(text)
    if not isinstance(record, dict):
        raise ValueError(f"no record in {path}")
    return record


def numbered(path: str, label: str, n: int) -> str:
    return f"{path}/{label}={n}"


def committed(spark: SparkSession, path: str, label: str, after: int | None = None) -> list[int]:
    """Committed numbers above ``after`` under ``path``, ascending, from one listing of the records."""
    prefix = f"{label}="
    names = [n[len(prefix) :] for n in names_in(spark, f"{path}/{COMMITS}") if n.startswith(prefix)]
    return sorted(int(n) for n in names if n.isdigit() and (after is None or int(n) > after))


def newest(spark: SparkSession, path: str, label: str) -> int | None:
    """Highest committed number, or ``None``."""
    return max(committed(spark, path, label), default=None)


def commit(spark: SparkSession, path: str, label: str, n: int) -> dict:
    """The commit record of one number: ``rows``, ``schema`` and what its writer added."""
    return read_json(spark, numbered(f"{path}/{COMMITS}", label, n))


def commits(spark: SparkSession, path: str, label: str, numbers: Sequence[int]) -> list[dict]:
    """The commit records of some numbers, read side by side."""
    with ThreadPoolExecutor(max_workers=READERS) as pool:
        return list(pool.map(lambda n: commit(spark, path, label, n), numbers))


def data_dirs(spark: SparkSession, path: str, label: str, numbers: Sequence[int]) -> list[str]:
    """Folders of the attempts that count.

    Below a ``basePath`` their last part is read as a column ``ATTEMPT``.
    """
    records = commits(spark, path, label, numbers)
    return [_attempt(path, label, n, r["attempt"]) for n, r in zip(numbers, records, strict=True)]


def _attempt(path: str, label: str, n: int, attempt: str) -> str:
    return f"{numbered(path, label, n)}/{ATTEMPT}={attempt}"


def committed_schema(spark: SparkSession, path: str, label: str, n: int) -> T.StructType:
    return T.StructType.fromJson(json.loads(commit(spark, path, label, n)["schema"]))


def write_numbered(
    df: DataFrame, path: str, label: str, n: int, empty: bool = False, by: Sequence[str] = (), **extra: object
) -> int:
    """Write ``df`` as one numbered Parquet directory, commit it, and return its row count.

    Within the directory, rows lie in folders by the columns ``by``.

    Rows are counted in the footers of the files just written: the plan runs once, and the count holds
    whatever tasks were repeated. (An observed metric comes through the listener bus, which drops events
    on a busy cluster.) Without rows nothing is left behind, unless ``empty`` is asked for. A number
    that is committed, before or while this attempt is written, raises ``FileExistsError``.
    """
    spark, whole, attempt = df.sparkSession, numbered(path, label, n), f"a{uuid.uuid4().hex}"
    if n in committed(spark, path, label):
        raise FileExistsError(f"{whole} is committed")
    target = _attempt(path, label, n, attempt)
    df.write.partitionBy(*by).parquet(target)
    rows = spark.read.schema(df.schema).parquet(target).count()
    if rows == 0 and not empty:
        _remove(spark, target)
        if not names_in(spark, whole):
            fs, p = _fs(spark, whole)
            fs.delete(p, False)
        return 0
    at = datetime.now(UTC).replace(tzinfo=None).isoformat(timespec="microseconds")
    record = {"rows": rows, "schema": df.schema.json(), "committed_at": at, "attempt": attempt, **extra}
    try:
        write_json(spark, numbered(f"{path}/{COMMITS}", label, n), record)
    except FileExistsError:
        _remove(spark, target)
        raise
    # Nothing else in the directory can be committed any more.
    for name in names_in(spark, whole):
        if name != f"{ATTEMPT}={attempt}":
            _remove(spark, f"{whole}/{name}")
    return rows


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def session_dir(spark: SparkSession, parent: str) -> str:
    """A new folder below ``parent`` that is deleted when the driver ends."""
    path = f"{parent.rstrip('/')}/millrace-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path
