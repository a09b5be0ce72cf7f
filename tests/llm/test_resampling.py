"""Feature buckets, the selection and the whole draw against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import resampling as rs
from millrace.llm.work import Scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    ws = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(ws), [" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % rs.BUCKETS


TEXTS = [
    None,
    "",
    " \n?!",
    "one",
    "One, TWO",
    "É é ñandú 漢字 😀x İ",
    "a" * 5000 + " b " + "c" * 129 + " " + "d" * 64 + " " + "e" * 65,
    "w x y " * 20_000,
]


@pytest.mark.parametrize("piece", [1, 50, 1 << 22])
def test_buckets_equal_plain_crc(monkeypatch, piece):
    monkeypatch.setattr(rs, "PIECE", piece)
    rng = random.Random(1)
    texts = [*TEXTS, *("".join(rng.choices("aZ9é .-\n", k=rng.randrange(30))) for _ in range(300)), None]
    column = pa.array(["x", *texts]).slice(1)
    at, work = 0, rs.Features()
    for data, offsets in rs._pieces(column):
        n_words, runs = work.buckets(data, offsets)
        for i in range(len(offsets) - 1):
            want_n, want = features(texts[at])
            assert n_words[i] == want_n
            assert sorted(b for text, bs in runs for b in bs[text == i].tolist()) == sorted(map(bucket, want))
            at += 1
    assert at == len(texts)


def test_carrying_over_long_runs():
    crc = rs.Crc()
    parts = [(b"abc", n) for n in (0, 1, 127, 128, 129, 1000, 70_001)]
    got = crc.carried(np.array([zlib.crc32(a) for a, _ in parts], np.uint32), np.array([n for _, n in parts])) ^ np.array(
        [zlib.crc32(b"z" * n) for _, n in parts], np.uint32
    )
    assert got.tolist() == [zlib.crc32(a + b"z" * n) for a, n in parts]


def plain(docs, target, percent=rs.PERCENT, least=rs.LEAST_WORDS):
    source, wanted = np.zeros(rs.BUCKETS, int), np.zeros(rs.BUCKETS, int)
    for texts, counts in (([t for _, t in docs], source), (target, wanted)):
        for t in texts:
            for f in features(t)[1]:
                counts[bucket(f)] += 1
    s_all, t_all = float(source.sum() + rs.BUCKETS), float(wanted.sum() + rs.BUCKETS)
    gain = [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), wanted.tolist())]
    rows = []
    for doc_id, text in docs:
        n, fs = features(text)
        weight = sum(gain[bucket(f)] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(fs), weight, score, n))
    order = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    k = percent * len(order) // 100
    return rows, order, k


def test_draw_equals_the_plain_one(spark):
    rng = random.Random(11)
    vocabulary = ["alpha", "Beta", "gamma", "δ", "omega", "x1", "y2", "zeta"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    docs = [(i * 37 % 1009, text(rng.choice([3, 19, 20, 40]))) for i in range(600)] + list(enumerate(TEXTS, 2000)) + [(None, text(30)), (None, None)]
    target = [text(12) for _ in range(5)] + [None]
    df = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, score string, rank int").repartition(4)
    got = [tuple(r) for r in rs.digest(rs.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=30)).collect()]
    rows, order, k = plain(docs, target, 30)
    ranks = {r: i + 1 for i, r in enumerate(order[:k])}
    assert k > 50 and sorted(map(repr, got)) == sorted(repr((*r[:4], ranks.get(r))) for r in rows)


def keyed(spark, keys):
    cols = "score long, none boolean, id long, h long, row long"
    return spark.createDataFrame([(s, i is None, i or 0, 0, n) for n, (s, i) in enumerate(keys)], cols).repartition(3)


@pytest.mark.parametrize("shape", ["spread", "tied", "one"])
def test_selection_finds_every_place(spark, shape):
    rng = random.Random(2)
    n = 230
    keys = {
        "spread": [(rng.randrange(10**6), i) for i in range(n)],
        "tied": [(rng.randrange(3), rng.choice([None, 1, 2])) for _ in range(n)],
        "one": [(5, 7)] * n,
    }[shape]
    df = Scratch(spark).keep(keyed(spark, keys))
    order = sorted(((-s, i is None, i or 0, 0, row) for row, (s, i) in enumerate(keys)))
    for k in (1, 2, 17, 115, 229, 230):
        found = rs.kth_key(df, k)
        assert (-found[0], *found[1:]) == order[k - 1]


def test_repeats_are_drawn_one_by_one(spark):
    docs = spark.createDataFrame([(4, "some words " * 20)] * 100, "doc_id long, text string")
    out = rs.resample(docs, spark.createDataFrame([("some words",)], "text string"))
    assert sorted(r["rank"] for r in out.filter("rank is not null").collect()) == [1, 2, 3, 4, 5] and out.count() == 100


def test_nothing_to_draw(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    few = spark.createDataFrame([(i, "a b c " * 10) for i in range(19)], "doc_id long, text string")
    assert rs.resample(none, none).count() == 0
    out = rs.digest(rs.resample(few, none))
    assert out.count() == 19 and out.filter("rank is not null").count() == 0
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert out.schema["rank"].dataType.simpleString() == "bigint" == out.schema["score"].dataType.simpleString()


def test_ranks_follow_ranges(spark):
    rows = [(i % 50, i) for i in range(500)]
    df = keyed(spark, rows).selectExpr("*", "true as eligible", "id as doc_id")
    got = {r["id"]: r["rank"] for r in rs.draw(Scratch(spark).keep(df), 200, Scratch(spark)).collect()}
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert got == {i: n + 1 if n < 200 else None for n, (_, i) in enumerate(order)}
