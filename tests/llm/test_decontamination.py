"""Hits against a plain search, and what is cut."""

import re

from millrace.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, n=10):
    w, hit, names = words(text), set(), set()
    for item_id, item in items:
        i = words(item)
        size = min(len(i), n)
        grams = {tuple(i[k : k + size]) for k in range(len(i) - size + 1)} if size else set()
        for k in range(len(w) - size + 1 if size else 0):
            if tuple(w[k : k + size]) in grams:
                hit |= set(range(k, k + size))
                names.add(str(item_id))
    return len(w), len(hit), sorted(names)


PASSAGE = " ".join(f"w{i}" for i in range(14))
ITEMS = [(1, PASSAGE), (10, PASSAGE.upper() + "!"), (2, "Äpfel und Birnen"), (3, None), (4, " ...!"), (5, "x"), (5, "x")]
DOCS = [
    (1, None),
    (2, ""),
    (3, f"before {PASSAGE} after"),
    (4, "w0 w1, W2; w3-w4 w5 w6 w7 w8\nw9 and w4 w5 w6"),
    (5, "äpfel und birnen Äpfel und Birnen"),
    (6, "x y x"),
    (7, f"{PASSAGE} " * 3000),
    (7, "other text under the same id x"),
    (7, "other text under the same id x"),
    (None, f"{PASSAGE}"),
    (8, "w0 w1 w2 w3 w4 w5 w6 w7 w8"),
]


def fixture(spark):
    docs = spark.createDataFrame([(i, t, 0, "a") for i, t in DOCS], "doc_id long, text string, n_words int, spans string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_hits_equal_a_plain_search(spark):
    docs, items = fixture(spark)
    got = sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], r["item_ids"]) for r in d.decontaminate(docs, items).collect())
    assert got == sorted((repr(i), *brute(t, ITEMS)) for i, t in DOCS)


def test_large_sets_take_the_shuffle_with_the_same_rows(spark, monkeypatch):
    docs, items = fixture(spark)
    want = sorted(map(repr, d.decontaminate(docs, items).collect()))
    monkeypatch.setattr(d, "BROADCAST_WINDOWS", 0)
    assert sorted(map(repr, d.decontaminate(docs, items).collect())) == want


def test_empty_sides(spark):
    docs, items = fixture(spark)
    assert d.decontaminate(docs.limit(0), items).count() == 0
    none = d.decontaminate(docs, items.limit(0))
    assert none.count() == len(DOCS) and none.filter("contaminated").count() == 0


def test_spans_are_cut_and_the_rest_stays(spark):
    text = "Keep, this; " + " ".join(f"Clean{i}" for i in range(30)) + f" {PASSAGE}! And -- that."
    rows = [(1, text, len(text)), (2, PASSAGE, 3), (3, "Nothing, here!", 14), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    out = {r["doc_id"]: r for r in d.remove_contaminated(docs, items).collect()}
    assert set(out) == {1, 3, 4}
    assert out[1]["text"] == text.replace(f"{PASSAGE}! ", "") and out[1]["n_chars"] == len(out[1]["text"])
    assert (out[3]["text"], out[3]["n_chars"], out[4]["text"]) == ("Nothing, here!", 14, None)


def test_rows_without_an_id_are_cut_by_their_own_spans(spark):
    clean = " ".join(f"clean{i}" for i in range(30))
    rows = [(None, f"{PASSAGE} {clean}"), (None, f"{clean} {PASSAGE}"), (None, " ".join(f"other{i}" for i in range(44)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r["text"].strip() for r in d.remove_contaminated(docs, spark.createDataFrame(ITEMS[:1], "item_id long, text string")).collect())
    assert got == [clean, clean, rows[2][1]]
