"""Scratch tables in the shared folder, and word helpers the operators have in common."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import session_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A word of the decontamination and near-duplicate operators, and a token of the others.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = r"[\x20\x09-\x0D]+"


class Scratch:
    """A new folder below ``spark.checkpoint.dir`` for one query's intermediate tables.

    Written tables are what later steps read, so a lost executor costs only its own running tasks.
    The folder goes when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="millrace-")
        self.spark = spark
        self.path = session_dir(spark, shared)

    def keep(self, df: DataFrame, *partition_by: str, compression: str | None = None, options: dict | None = None) -> DataFrame:
        """Write ``df`` and read it back: its lineage ends here."""
        path = self.new_path()
        df.write.options(**options or {}).partitionBy(*partition_by).parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def new_path(self) -> str:
        return f"{self.path}/{uuid.uuid4().hex}"


def mounted(path: str) -> str:
    """Local name of a folder in the shared store, for workers that map its files into memory."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"workers map files of this folder: mount it and name it file:..., not {path}")
    return unquote(parts.path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Lower-cased words of letters, digits and non-ASCII characters; null and empty text have none."""
    return F.filter(F.split(F.coalesce(lower_ascii(text), F.lit("")), NOT_WORD), lambda w: w != "")


def tokens(text: Column) -> Column:
    """Runs of anything but blanks, unchanged; null and empty text have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def with_columns_last(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns; input columns of the same name (in any case) give way to them."""
    taken = {c.lower() for c in columns}
    return df.select(
        *[df[f"`{c}`"] for c in df.columns if c.lower() not in taken],
        *[value.alias(name) for name, value in columns.items()],
    )
