"""Commit records as a stream: what is committed arrives once, what is torn never does."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.files import COMMITS, make_dir

# The numbers one micro-batch brought, ascending, and the micro-batch's own number.
Step = Callable[[list[int], int], None]


def commit_stream(spark: SparkSession, path: str, label: str, most: int | None = None) -> DataFrame:
    """``number`` of every commit record below ``path``, in the order of the commits.

    The stream reads the folder of the records, not that of the data: a directory without record, or
    one that is being written, is not seen. Each micro-batch takes ``most`` records, by default all
    there are. Records are small; the data they name are read by whoever handles the numbers.
    """
    folder = f"{path}/{COMMITS}"
    make_dir(spark, folder)
    reader = spark.readStream.schema("rows long")
    if most is not None:
        reader = reader.option("maxFilesPerTrigger", most)
    name = F.substring_index("_metadata.file_name", "=", -1)
    named = reader.json(folder).filter(F.startswith("_metadata.file_name", F.lit(f"{label}=")))
    return named.select(name.cast("long").alias("number"))


def start(records: DataFrame, checkpoint: str, step: Step, **trigger: object) -> StreamingQuery:
    """Start handling a commit stream; ``step`` must give the same result when it is repeated.

    The stream's checkpoint says which records belong to which micro-batch, and moves after ``step``
    has returned: a run that stops in between repeats the step with the same numbers.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # One small row per commit record.
        numbers = sorted(r["number"] for r in batch.collect())
        if numbers:
            step(numbers, batch_id)

    writer = records.writeStream.trigger(**(trigger or {"availableNow": True}))
    return writer.option("checkpointLocation", checkpoint).foreachBatch(handle).start()
