"""Links and components against all pairs."""

import numpy as np
import pytest

from millrace.llm import vectors


def brute(rows, threshold=0.95):
    ok = [e is not None and len(e) > 0 and all(v is not None and np.isfinite(v) for v in e) and any(e) for _, e in rows]
    n = len(rows)
    close = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], float) / np.abs(rows[k][1]).max() for k in (i, j))
                close[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    label = list(range(n))
    ids = [r[0] for r in rows]
    for _ in range(n):
        for i in range(n):
            for j in np.flatnonzero(close[i]):
                label[i] = min(label[i], label[j])
    least = {}
    for i in range(n):
        least[label[i]] = min(least.get(label[i], ids[i]), ids[i])
    return sorted((ids[i], int(close[i].sum()), least[label[i]], ids[i] == least[label[i]]) for i in range(n))


def fixture():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(180):
        noise = rng.choice([0.0, 0.05, 0.15, 0.3]) * rng.normal(size=16)
        rows.append((i * 7 % 400, [float(v) for v in centres[i % 12] + noise]))
    same = rows[5][1]
    rows += [(1000 + i, same) for i in range(40)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [None] * 16), (2004, [float("nan")] + [1.0] * 15)]
    rows += [(2005, [float("inf")] + [1.0] * 15), (2006, [v * 1e200 for v in same]), (2007, [v * 1e-200 for v in same])]
    return [*rows, (2008, [1.0, 2.0]), (2009, [2.0, 4.0]), (2010, [-v for v in same]), (2006, [v * 1e200 for v in same])]


@pytest.mark.parametrize("block, leaf", [(4096, 256), (20, 4)])
def test_all_pairs(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "LEAF", leaf)
    rows = fixture()
    df = spark.createDataFrame([(i, e, 3) for i, e in rows], "vec_id long, embedding array<double>, node int").repartition(3)
    got = sorted(tuple(r) for r in vectors.link_vectors(df).collect())
    assert got == brute(rows)


def test_recursion_skips_nothing_near():
    rng = np.random.default_rng(1)
    x = np.sort(rng.normal(size=(300, 4)), axis=0)
    axes = np.eye(4)
    pack = lambda v: {"nodes_a": np.arange(len(v)).tobytes(), "copies_a": np.ones(len(v), int).tobytes(), "x_a": v.tobytes()}
    a = vectors.Sequence(pack(x), axes, "a")
    found = set()
    for left, right in vectors.near_leaves(a, a, True, 0.2):
        near = np.linalg.norm(x[left][:, None] - x[right][None], axis=2) <= 0.2
        found |= {(i + left.start, j + right.start) for i, j in zip(*np.nonzero(near)) if i + left.start < j + right.start}
    every = np.linalg.norm(x[:, None] - x[None], axis=2) <= 0.2
    assert found == {(i, j) for i, j in zip(*np.nonzero(every)) if i < j}


def test_nothing_to_link(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vectors.link_vectors(empty).count() == 0
    nulls = spark.createDataFrame([(1, None), (1, None), (None, [0.0])], "vec_id long, embedding array<float>")
    rows = vectors.link_vectors(nulls).collect()
    assert sorted((repr(r["vec_id"]), r["n_links"], repr(r["component_id"])) for r in rows) == [
        ("1", 0, "1"), ("1", 0, "1"), ("None", 0, "None")
    ]


def test_sketch_leaves_out_no_close_pair():
    """Where the sketch decides and where it leaves so many that all products are taken."""
    rng = np.random.default_rng(4)
    for spread, least in ((1.0, 0.5), (1.0, 0.95), (0.05, 0.9), (0.2, 0.95)):
        x = vectors.unit_rows(rng.normal(size=40) + spread * rng.normal(size=(120, 40)))
        axes = np.linalg.qr(rng.normal(size=(40, 40)))[0]
        pack = {"nodes_a": np.arange(120).tobytes(), "copies_a": np.ones(120, int).tobytes(), "x_a": x.tobytes()}
        seq = vectors.Sequence(pack, axes, "a")
        i, j = vectors.close_pairs(seq, slice(0, 70), seq, slice(50, 120), least)
        want = np.argwhere(x @ x.T >= least)
        assert {*zip(i, j)} == {(p, q) for p, q in want if p < 70 and q >= 50}


def test_pairs_of_blocks_carry_no_vectors(spark, monkeypatch, tmp_path):
    """What is shuffled for the pairs does not grow with the vectors."""
    monkeypatch.setattr(vectors, "BLOCK", 50)
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=64)]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    joined, run = [], type(df).mapInPandas
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, *a, **b: joined.append(self) or run(self, *a, **b))
    assert vectors.link_vectors(df).count() == 600
    pairs = joined[-1]
    assert pairs.count() > 60 and not {"binary", "array<long>", "array<double>"} & {kind for _, kind in pairs.dtypes}


def test_copies_in_many_batches_are_one_class(spark):
    rows = [(i if i % 3 else None, [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.98, 0.1, 0.0]][i % 9 // 3]) for i in range(90)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
        got = {(r["n_links"], r["component_id"]) for r in vectors.link_vectors(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(59, 1), (29, 4)}
