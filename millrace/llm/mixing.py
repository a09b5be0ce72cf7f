"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import with_columns_last

# 13 hexadecimal digits make a number below 2**52, which a double holds exactly.
DIGITS, SPAN = 13, float(1 << 52)
# More sources than this are joined by a shuffle instead of a broadcast; the rows are the same.
BROADCAST_SOURCES = 100_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that follows from the parts alone, whatever task or retry asks for it."""
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("double") / F.lit(SPAN)


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... far into the tail, summed in logarithms so no mean underflows."""
    top = F.ceil(rate + F.lit(12.0) * F.sqrt(rate) + F.lit(30.0)).cast("int")
    start = F.struct(
        (-rate).alias("logp"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("cdf")
    )

    def step(acc: Column, k: Column) -> Column:
        logp = acc["logp"] + F.log(rate) - F.log(k.cast("double"))
        total = acc["sum"] + F.exp(logp)
        return F.struct(
            logp.alias("logp"), total.alias("sum"), F.concat(acc["cdf"], F.array(total)).alias("cdf")
        )

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), top), start, step)["cdf"]).otherwise(
        F.array(F.lit(1.0))
    )


def source_rates(
    docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 0.5, scale: float = 1.0
) -> DataFrame:
    """``(source, rate)``: how often a document of each source is repeated on average.

    A source's size is the characters of its texts. Its target weight is the one given, or its size to
    the power ``temperature``; ``scale`` is the size of the mixture in sizes of the input. Sources
    missing from given weights get none. A source (or a whole table) without characters keeps rate 1,
    or 0 where its given weight is 0 or missing. The null source is a source of its own.
    """
    sizes = docs.groupBy(F.col("source")).agg(
        F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).cast("double").alias("size")
    )
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("size", F.lit(float(temperature))))
        empty = F.lit(1.0)
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        spark = docs.sparkSession
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, weight double")
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("name")), "left").select(
            "source", "size", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
        empty = F.when(F.col("weight") > 0, 1.0).otherwise(0.0)
    total = weighed.agg(
        F.sum("size").alias("all_size"), F.sum(F.when(F.col("size") > 0, F.col("weight"))).alias("all_weight")
    ).first()
    all_size, all_weight = float(total["all_size"] or 0), float(total["all_weight"] or 0)
    rate = F.col("weight") * F.lit(scale * all_size / all_weight) / F.col("size") if all_weight else F.lit(0.0)
    return weighed.select("source", F.when(F.col("size") > 0, rate).otherwise(empty).alias("rate"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = 0.5,
    scale: float = 1.0,
    seed: int = 10,
) -> DataFrame:
    """Repeat documents so that the sources reach their target weights, in globally shuffled order.

    Every document gets a Poisson count with its source's mean repetition rate, found by inverting the
    distribution at a number hashed from ``seed`` and ``doc_id``: counts need no coordination, and
    retries and reruns give the same. A document with count 0 is left out, others appear once per
    ``copy`` 1..count, at a place hashed from seed, id and copy (``shuffle_key``).

    Sources are sized by a partial aggregate (a hot source costs one row per task) and their rates
    broadcast while their number is bounded. Rows are dealt out by the shuffle key, so neither a hot
    source nor repeated rows gather in one task. Rows with the same id get the same count; a null id
    hashes as an empty text; null text has no characters. Input columns named like the two new ones
    give way. An empty table stays empty.
    """
    rates = source_rates(docs, weights, temperature, scale).select(
        F.col("source").alias("__source"), poisson_cdf(F.col("rate")).alias("__cdf")
    )
    # The rates are one row per source; count them before deciding that they are small.
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    u = uniform(F.lit(seed), F.col("doc_id"))
    counted = docs.join(rates, docs["source"].eqNullSafe(F.col("__source")), "left").withColumn(
        "__n", F.size(F.filter(F.col("__cdf"), lambda c: c <= u))
    )
    copies = counted.filter("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    key = F.concat_ws(
        "|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("__copy").cast("string")
    )
    out = with_columns_last(
        copies, copy=F.col("__copy").cast("int"), shuffle_key=F.substring(F.md5(key), 1, 16)
    ).drop("__source", "__cdf", "__n", "__copy")
    return out.repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key")


def oracle(temperature: float = 0.5, seed: int = 10) -> str:
    """The same rows of ``documents`` in DuckDB SQL."""
    return f"""with recursive sized as (
 select source, cast(sum(coalesce(length(text), 0)) as double) as size from documents group by source),
totals as (select sum(size) as all_size, sum(case when size > 0 then pow(size, {temperature}) end) as w from sized),
rates as (select source, case when size > 0
  then pow(size, {temperature}) * (1.0 * all_size / w) / size else 1.0 end as rate from sized, totals),
pmf as (select source, rate, 0 as k, -rate as logp, exp(-rate) as cdf from rates
 union all select source, rate, k + 1, logp + ln(rate) - ln(k + 1), cdf + exp(logp + ln(rate) - ln(k + 1))
 from pmf where k < ceil(rate + 12 * sqrt(rate) + 30)),
steps as (select source, list(cdf) as cdf from pmf group by source),
counted as (select d.*, len(list_filter(s.cdf, lambda c: c <=
  cast(('0x' || substr(md5('{seed}|' || coalesce(cast(d.doc_id as varchar), '')), 1, {DIGITS})) as bigint)
  / {SPAN})) as n
 from documents d join steps s on d.source is not distinct from s.source)
select c.* exclude (n), cast(k.copy as integer) as copy,
 substr(md5('{seed}|' || coalesce(cast(c.doc_id as varchar), '') || '|' || k.copy), 1, 16) as shuffle_key
from counted c, lateral (select unnest(range(1, c.n + 1)) as copy) k"""
