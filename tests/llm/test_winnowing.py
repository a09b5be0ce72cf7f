"""Winnowing against a plain version, and documents beside their edits."""

import hashlib
import random
import re
import zlib

import pytest

from millrace.llm import winnowing as wn

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text, k=wn.GRAM, w=wn.WINDOW):
    """``(pos, hash)`` of each window's least gram, the rightmost of equal ones."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    codes = [zlib.crc32(x.encode()) % wn.PRIME for x in WORD.findall(lower)]

    def gram(run):
        value = 0
        for c in run:
            value = (value * wn.BASE + c) % wn.PRIME
        return value

    grams = [gram(codes[i : i + k]) for i in range(max(len(codes) - k + 1, 1))] if codes else []
    chosen = set()
    for i in range(max(len(grams) - w + 1, 1) if grams else 0):
        window = grams[i : i + w]
        chosen.add((max(i + j for j, g in enumerate(window) if g == min(window)), min(window)))
    return sorted(chosen)


def alike(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def texts(n):
    rng = random.Random(12)
    vocabulary = ["ab", "Cd", "é", "ñu1", "x", "😀y", "lorem", "IPSUM"]
    return ["".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(rng.choice([0, 1, 3, 5, 9, 14, 60]))) for _ in range(n)]


@pytest.mark.parametrize("k, w", [(5, 8), (1, 1), (3, 4), (7, 5)])
def test_fingerprints_equal_the_plain_ones(spark, k, w):
    rows = [None, "", "?!", "one", "a a a a a a a a a a a a a a a a a a", "w " * 30_000, *texts(60)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, fingerprint string")
    got = {r["doc_id"]: [tuple(p) for p in r["fingerprint"]] for r in wn.fingerprint(docs, k, w).collect()}
    assert got == {i: plain(t, k, w) for i, t in enumerate(rows)}


def test_shared_run_is_always_found(spark):
    """A common run of GRAM + WINDOW - 1 words gives a common hash, wherever it stands."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    run = " ".join(word() for _ in range(wn.GRAM + wn.WINDOW - 1))
    rows = [(i, " ".join([*(word() for _ in range(rng.randrange(40))), run, *(word() for _ in range(rng.randrange(40)))])) for i in range(40)]
    found = [{p["hash"] for p in r["fingerprint"]} for r in wn.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert all(a & b for a in found for b in found)


def expected(rows):
    """Rows of the digest; order: ids descending, null last (ids here differ, or the rows are equal)."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other = plain(text), plain(edited)
        listed = [",".join(f"{p}:{h}" for p, h in m) for m in (own, other)]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc_id, len(text), sha, *listed, alike(own, other), alike(own, plain(following))))
    return sorted(map(repr, out))


def test_edits_equal_the_plain_ones(spark):
    ids = random.Random(5).sample(range(-500, 5000), 300)
    rows = [*zip(ids, texts(297) + [None, "", "long " * 5000], strict=True), (None, "last of all"), (7000, "same rows"), (7000, "same rows")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, n_chars int, marks string").repartition(5)
    got = [tuple(r) for r in wn.digest(wn.edit_marks(docs)).collect()]
    assert sorted(map(repr, got)) == expected(rows)


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(3, "abcdef ghij")], "doc_id long, text string")
    assert sorted(repr(tuple(r)) for r in wn.digest(wn.edit_marks(one)).collect()) == expected([(3, "abcdef ghij")])
    assert wn.edit_marks(one.limit(0)).count() == 0 and wn.fingerprint(one.limit(0)).count() == 0


def test_one_id_with_many_texts_is_cut_into_ranges(spark):
    rows = [(None, f"text number {i}") for i in range(400)] + [(i, "other") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranges = wn.in_ranges(docs, wn.Scratch(spark)).filter("not guest").groupBy("range").count().collect()
    assert sum(r["count"] for r in ranges) == 500 and max(r["count"] for r in ranges) < 200
    assert wn.edit_marks(docs).count() == 500


def test_no_python_on_the_main_path(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = wn.digest(wn.edit_marks(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
