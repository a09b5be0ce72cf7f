"""Codes and codebooks against Lloyd rounds in plain Python."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import vector_codes as vc


def plain(rows):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4)
    kept = [(i, v + [0] * (4 * width - len(v)), label) for i, v, label in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    books = [[v[p * width : (p + 1) * width] for _, v, _ in first] for p in range(4)]

    def assign(v, p):
        part = v[p * width : (p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(books[p]))

    for _ in range(4):
        chosen = [[assign(v, p)[1] for _, v, _ in kept] for p in range(4)]
        for p in range(4):
            for e in set(chosen[p]):
                members = [v[p * width : (p + 1) * width] for (_, v, _), c in zip(kept, chosen[p]) if c == e]
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    coded = [(i, label, [assign(v, p) for p in range(4)]) for i, v, label in kept]
    errors = {}
    for _, label, parts in coded:
        errors[label] = errors.get(label, 0) + sum(d for d, _ in parts)
    return sorted(
        repr((i, "".join(f"{e:02x}" for _, e in parts), sum(d for d, _ in parts), errors[label], sha)) for i, label, parts in coded
    )


def run(spark, rows, kind="float"):
    df = spark.createDataFrame([(*r, 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, position int")
    return sorted(repr(tuple(r)) for r in vc.digest(vc.compress(df.repartition(3))).collect())


def f32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("size, width", [(700, 8), (40, 6), (1, 4)])
def test_plain_rounds(spark, size, width):
    rng = random.Random(size)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(9)]
    rows = [
        (rng.randrange(2000), [f32(c + rng.choice([0, 0.01, 0.2]) * rng.uniform(-1, 1)) for c in rng.choice(centres)], rng.choice([None, 1, 2]))
        for _ in range(size)
    ]
    bad = [(1, None, 1), (2, [None] * width, 1), (3, [float("nan")] * width, 2), (4, [float("inf")] * width, None)]
    odd = [(5, [], 7), (6, [0.5], None), (None, [0.25] * width, None), (8, [0.25] * width, 2), (8, [0.25] * width, 2)]
    assert run(spark, rows + bad) == plain(rows + bad)
    assert run(spark, rows + bad + odd) == plain(rows + bad + odd)


def test_hot_vector_has_several_owners(spark):
    """Half of all rows are one vector: it is cut into owners, and the codes stay right."""
    rng = random.Random(3)
    rows = [(i, [f32(rng.uniform(-1, 1)) for _ in range(4)] if i % 2 else [0.5] * 4, i % 3) for i in range(1200)]
    assert run(spark, rows) == plain(rows)
    members = spark.range(1000).select(F.lit(0).alias("position"), F.lit(7).alias("entry"), F.col("id").alias("row"))
    loads = members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"))
    assert members.select(vc._salt(loads, 8).alias("s")).distinct().count() == 8


def test_large_components_stay_exact(spark):
    rows = [(i, [float(x), -float(x), x / 3, 1.0], None) for i, x in enumerate([0, 1e5, 1e6, 123456.789, 1e6, 1e8, 1e8 + 1])]
    assert run(spark, rows, "double") == plain(rows)
    far = [(0, [0.0] * 4, 1), (1, [1e300] * 4, 1), (2, [-1e300] * 4, None)]
    assert len(run(spark, far, "double")) == 3


def test_only_movers_are_shuffled(spark, monkeypatch):
    """After the first round, arrivals are the parts whose entry has changed, and nothing else."""
    moved = []
    keep = vc.Scratch.keep

    def spy(self, df, *by):
        out = keep(self, df, *by)
        if by == ("moved",):
            moved.append((out.count(), out.filter("moved").count()))
        return out

    monkeypatch.setattr(vc.Scratch, "keep", spy)
    rng = random.Random(9)
    rows = [(i, [f32(rng.gauss(0, 1)) for _ in range(8)], None) for i in range(600)]
    run(spark, rows)
    assert moved[0] == (2400, 2400) and all(0 < m < 1200 for _, m in moved[1:]) and all(n == 2400 for n, _ in moved)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    out = vc.digest(vc.compress(df))
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
