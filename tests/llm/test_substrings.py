"""The FM-index against plain search, and removal against a plain count of windows."""

import random
import re

import numpy as np
import pytest

from millrace.llm import substrings
from millrace.llm.fm_index import FMIndex, RankBits, bounded_suffix_array


def test_rank_bits():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        bits = rng.integers(0, 2, n).astype(np.uint8)
        want = np.r_[0, np.cumsum(bits)]
        assert (RankBits(bits).rank(np.arange(n + 1)) == want).all()


@pytest.mark.parametrize("letters", [1, 2, 5, 300])
def test_backward_search_counts_every_occurrence(letters):
    rng = np.random.default_rng(letters)
    text = np.r_[rng.integers(0, letters + 1, 600), 0]
    index = FMIndex(text, 13)
    plain = " ".join(map(str, text))
    for _ in range(60):
        size = int(rng.integers(1, 14))
        at = int(rng.integers(0, 600 - size))
        pattern = text[at : at + size] if rng.random() < 0.7 else rng.integers(1, letters + 1, size)
        if (pattern == 0).any():
            continue
        low, high = np.array([0]), np.array([index.size])
        for c in pattern[::-1]:
            low, high = index.extend_left(np.array([c]), low, high)
        starts = [i for i in range(len(text) - size + 1) if (text[i : i + size] == pattern).all()]
        assert sorted(index.suffixes[low[0] : max(low[0], high[0])]) == starts, (plain, pattern)


def test_matching_statistics():
    rng = np.random.default_rng(9)
    text = np.r_[0, rng.integers(1, 4, 400), 0]
    index = FMIndex(text, 13)
    query = np.r_[0, rng.integers(1, 4, 200)]
    ends = np.arange(1, len(query) + 1)
    length, _, _ = index.matching(query, ends, 13)
    seen = {tuple(text[i : i + k]) for k in range(1, 14) for i in range(len(text) - k + 1)}
    for e, got in zip(ends, length):
        want = max((k for k in range(1, min(13, e) + 1) if 0 not in query[e - k : e] and tuple(query[e - k : e]) in seen), default=0)
        assert got == want


def test_bounded_suffix_array_sorts_by_the_first_codes():
    text = np.tile([1, 2, 1, 3], 50)
    order = bounded_suffix_array(text, 13)
    keys = [tuple(text[i : i + 13]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(200))


def brute(docs, window=13):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    key = lambda i: -(2**70) if i is None else i
    first = {}
    for (i, _), w in zip(docs, split):
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, 2**70), key(i))
    out = []
    for (i, _), w in zip(docs, split):
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < key(i):
                gone |= set(range(k, k + window))
        out.append((repr(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def corpus():
    rng = random.Random(4)
    word = lambda: rng.choice("ab") * rng.randrange(1, 9) + rng.choice(["", "É", "!"])
    passage = [word() for _ in range(60)]
    docs = []
    for i in range(120):
        w = [word() for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(0, 3)):
            a = rng.randrange(0, 45)
            at = rng.randrange(0, len(w) + 1)
            w[at:at] = passage[a : a + rng.randrange(8, 40)]
        docs.append((i * 3 % 127, rng.choice([" ", "\n", "\t "]).join(w)))
    whole = " ".join(passage)
    docs += [(500, None), (501, ""), (502, whole), (503, whole), (503, whole), (503, whole + " other end"), (None, whole)]
    return [*docs, (600, f"{whole} " * 400), (601, "x " * 30), (602, "x " * 13), (603, "x " * 12)]


@pytest.mark.parametrize("piece, shard", [(1 << 21, 1 << 20), (500, 300)])
def test_removal_equals_a_plain_count(spark, monkeypatch, piece, shard):
    monkeypatch.setattr(substrings, "PIECE", piece)
    monkeypatch.setattr(substrings, "PER_SHARD", shard)
    docs = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, n_words string, h int").repartition(3)
    rows = substrings.remove_repeats(df).collect()
    assert sorted((repr(r["doc_id"]), r["n_words"], r["n_removed"], r["text"]) for r in rows) == brute(docs)


def test_empty_table_and_no_repeats(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(empty).count() == 0
    some = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert {r["n_removed"] for r in substrings.remove_repeats(some).collect()} == {0}
