"""Poisson replication: counts, rates and edge cases."""

from pyspark.sql import functions as F

from millrace.llm import mixing


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copy string")


def test_rates_follow_weights(spark):
    rows = [(i, "x" * 10, "big" if i % 4 else "small", "old") for i in range(4000)]
    mixed = mixing.mix_sources(docs_of(spark, rows), {"big": 1.0, "small": 1.0})
    n = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["big"] - 2000) < 200 and abs(n["small"] - 2000) < 200
    assert dict(mixed.dtypes)["copy"] == "int" and mixed.columns.count("copy") == 1


def test_counts_are_poisson_quantiles(spark):
    for rate in (0.3, 1.0, 7.5, 900.0):
        cdf = spark.range(1).select(mixing.poisson_cdf(F.lit(rate)).alias("c")).first()["c"]
        assert abs(cdf[-1] - 1) < 1e-9 and all(a <= b + 1e-15 for a, b in zip(cdf, cdf[1:]))
        mean = sum(1 - c for c in cdf)
        assert abs(mean - rate) < 1e-6 * max(1, rate)


def test_same_counts_every_time_and_all_copies(spark):
    docs = docs_of(spark, [(i, "ab" * (i % 7 + 1), f"s{i % 3}", "") for i in range(300)])
    one = sorted((r["doc_id"], r["copy"]) for r in mixing.mix_sources(docs).collect())
    assert one == sorted((r["doc_id"], r["copy"]) for r in mixing.mix_sources(docs.repartition(7)).collect())
    assert all((d, c - 1) in set(one) for d, c in one if c > 1)


def test_order_is_global_and_not_by_source(spark):
    docs = docs_of(spark, [(i, "abc", "a" if i < 500 else "b", "") for i in range(1000)])
    seen = [r["source"] for r in mixing.mix_sources(docs).collect()]
    assert 100 < sum(a != b for a, b in zip(seen, seen[1:]))


def test_null_empty_and_repeated(spark):
    rows = [(None, "abc", None, ""), (1, None, "a", ""), (1, None, "a", ""), (2, "", "b", ""), (3, "x" * 100_000, "c", "")]
    mixed = mixing.mix_sources(docs_of(spark, rows), scale=3.0).collect()
    ones = [r["copy"] for r in mixed if r["doc_id"] == 1]
    assert sorted(ones) == sorted(2 * list(range(1, len(ones) // 2 + 1)))
    assert mixing.mix_sources(docs_of(spark, [])).count() == 0
    assert mixing.mix_sources(docs_of(spark, [(1, None, "a", "")])).count() in range(5)
    assert mixing.mix_sources(docs_of(spark, rows), {"c": 0.0}).count() == 0
