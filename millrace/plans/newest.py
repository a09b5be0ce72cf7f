"""The index of newest rows that a ``latest`` mart takes replaced rows back from.

Part 0 holds the newest row of every key, each later part those of the keys its versions brought. Rows
lie in folders by a hash of their key, so a refresh reads the folders that the new keys fall in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.latest import latest_by_key
from millrace.operators.retraction import TAKE, extremes, lost
from millrace.operators.states import VERSION, MartSpec, counted_rows, mart_keys
from millrace.plans.contracts import CONTRACTS
from millrace.sources.files import ATTEMPT, commit, committed, data_dirs, write_numbered

PART, BUCKET = "part", "bucket"
# Rows per folder aimed at, and the most folders of a part.
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 4096


def _write(rows: DataFrame, mart: MartSpec, index: str, part: int, upto: int, buckets: int) -> None:
    key = CONTRACTS[mart.source].key
    dealt = rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).repartition(BUCKET)
    write_numbered(dealt, index, PART, part, empty=True, by=[BUCKET], upto=upto, buckets=buckets)


def start_index(newest: DataFrame, mart: MartSpec, index: str, rows: int, upto: int) -> None:
    """Write part 0; ``rows`` bounds the number of keys."""
    _write(newest, mart, index, 0, upto, min(MOST_BUCKETS, rows // BUCKET_ROWS + 1))


def append_index(newest: DataFrame, mart: MartSpec, index: str, part: int, upto: int) -> None:
    _write(newest, mart, index, part, upto, commit(newest.sparkSession, index, PART, 0)["buckets"])


def read_index(spark: SparkSession, mart: MartSpec, index: str, parts: list[int]) -> DataFrame:
    """Rows of the given parts, with their part and folder."""
    keep = {CONTRACTS[mart.source].key, VERSION, "updated_at", *mart.reads}
    fields = [T.StructField(f.name, f.dataType) for f in CONTRACTS[mart.source].schema.fields if f.name in keep]
    full = T.StructType([*fields, T.StructField(PART, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(full).option("basePath", index).parquet(*data_dirs(spark, index, PART, parts)).drop(ATTEMPT)


def newest_rows(rows: DataFrame, key: str) -> DataFrame:
    """Of each key the row of the newest part."""
    return latest_by_key(rows, [key], PART, ()).drop(PART, BUCKET)


def replaced_rows(spark: SparkSession, mart: MartSpec, index: str, part: int) -> tuple[DataFrame, DataFrame]:
    """The rows of a part, and the rows that were newest for their keys before it.

    Only folders that the part's keys fall in are read, and of their rows only those of these keys are
    shuffled.
    """
    key = CONTRACTS[mart.source].key
    fresh = read_index(spark, mart, index, [part])
    # At most one number per folder.
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
    earlier = [p for p in committed(spark, index, PART) if p < part]
    before = read_index(spark, mart, index, earlier).filter(F.col(BUCKET).isin(touched))
    former = before.join(fresh.select(key), key, "left_semi")
    return fresh.drop(PART, BUCKET), newest_rows(former, key)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & left[k].eqNullSafe(right[k])
    return test


def with_extremes(delta: DataFrame, earlier: DataFrame, index: str, mart: MartSpec, part: int) -> DataFrame:
    """``delta`` with the extremes its groups have from now on.

    ``earlier`` are the states of the parts before. Where the rows taken back do not reach a group's
    extreme, the new one is the better of the old one and the added rows'. Only groups that lost their
    extreme are looked up among the newest rows.
    """
    spark, keys = delta.sparkSession, list(mart.keys)
    states = extremes(mart)
    before = earlier.groupBy(*keys).agg(*[F.max_by(s, PART).alias(f"{s}__was") for s, _, _ in states])
    joined = delta.join(before, _same(delta, before, keys), "left").select(delta["*"], *[before[f"{s}__was"] for s, _, _ in states])

    def gone(state: str, kind: str) -> Column:
        was, taken = F.col(f"{state}__was"), F.col(lost(state))
        return taken.isNotNull() & F.coalesce(taken >= was if kind == "max" else taken <= was, F.lit(True))

    better = {"max": F.greatest, "min": F.least}
    open_ = F.lit(False)
    for s, _, kind in states:
        open_ = open_ | gone(s, kind)
    done = joined.withColumns({s: better[kind](F.col(s), F.col(f"{s}__was")) for s, _, kind in states})
    plain = delta.drop(*[lost(s) for s, _, _ in states]).columns
    unsettled = joined.filter(open_).select(*keys)
    if unsettled.isEmpty():
        return done.select(*plain)
    found = _recomputed(spark, unsettled, index, mart, part)
    again = done.join(found, _same(done, found, keys), "left")
    values = {s: F.when(gone(s, kind), found[f"{s}__now"]).otherwise(done[s]) for s, _, kind in states}
    return again.select(*[values[c].alias(c) if c in values else done[c] for c in plain])


def _recomputed(spark: SparkSession, groups: DataFrame, index: str, mart: MartSpec, part: int) -> DataFrame:
    """The extremes of the given groups over the newest rows up to a part."""
    key, keys = CONTRACTS[mart.source].key, list(mart.keys)
    rows = read_index(spark, mart, index, [p for p in committed(spark, index, PART) if p <= part])
    named = [k.alias(f"__{name}") for k, name in zip(mart_keys(mart), keys, strict=True)]

    def of_groups(df: DataFrame) -> DataFrame:
        marked = counted_rows(df, mart).select("*", *named)
        test = F.lit(True)
        for k in keys:
            test = test & marked[f"__{k}"].eqNullSafe(groups[k])
        return marked.join(groups, test, "left_semi")

    # A row of such a group may have been replaced by one of another group, so all rows of its key count.
    candidates = of_groups(rows).select(key).distinct()
    newest = of_groups(newest_rows(rows.join(candidates, key, "left_semi"), key))
    return newest.groupBy(*[F.col(f"__{k}").alias(k) for k in keys]).agg(
        *[TAKE[kind](column).alias(f"{s}__now") for s, column, kind in extremes(mart)]
    )
