"""Links against all pairs of shingle sets, recall, and components."""

import random
import re

import numpy as np
import pytest

from millrace.llm import jaccard
from millrace.llm.components import components
from millrace.llm.work import Scratch


def sets_of(docs):
    out = []
    for _, text in docs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    return out


def brute(docs):
    sets, n = sets_of(docs), len(docs)
    near = [[j for j in range(n) if i != j and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        for i in range(n):
            label[i] = min([label[i], *[label[j] for j in near[i]]])
    least = {}
    for i in range(n):
        least[label[i]] = min(least.get(label[i], 2**60), docs[i][0])
    return sorted((docs[i][0], len(near[i]), least[label[i]], docs[i][0] == least[label[i]]) for i in range(n))


def corpus(groups=12, size=9):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 7)))
    passage = [word() for _ in range(50)]
    docs = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([6, 30, 120]))]
        for k in range(size):
            w = list(base)
            for _ in range(rng.randrange(0, max(1, len(w) // 25) + 1)):
                w[rng.randrange(len(w))] = word()
            docs.append((len(docs) * 5 % 997, " ".join(w)))
        docs.append((len(docs) * 5 % 997, " ".join([*base[: len(base) // 3], *passage])))
    copy = docs[3][1]
    docs += [(2000 + i, copy.upper() + "!") for i in range(50)]
    docs += [(3000, None), (3001, ""), (3002, "?!"), (3003, "one two"), (3004, "One, two"), (3005, "one"), (3006, " ".join(passage) * 300)]
    return docs


def test_links_and_groups(spark):
    docs = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, n_links string").repartition(3)
    rows = jaccard.near_duplicates(df).collect()
    got = sorted((r["doc_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows)
    want = brute(docs)
    links = lambda rows: sum(r[1] for r in rows)
    assert all(g[1] <= w[1] for g, w in zip(got, want)) and links(got) >= 0.99 * links(want) > 1000
    assert sum(g != w for g, w in zip(got, want)) <= 2
    alone = {r["doc_id"]: r for r in rows}
    assert [alone[i]["n_links"] for i in (3000, 3001, 3002, 3003, 3004)] == [0, 0, 0, 1, 1]
    assert alone[2007]["class_id"] == min(i for i, t in docs if t and t.upper() == docs[3][1].upper())


@pytest.mark.parametrize("small, often, chunk", [(8, 4, 16)])
def test_large_groups_take_leaders_and_chunks_with_the_same_links(spark, monkeypatch, small, often, chunk):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    docs = [(i, " ".join(w if rng.random() > 0.004 else f"x{rng.random()}" for w in base)) for i in range(150)]
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "OFTEN", often)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rows = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = sorted((r["doc_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows)
    assert got == brute(docs)


def test_one_run_finds_the_predicted_share():
    """Paths of pairs at exactly the threshold meet about as often as the branching process says."""
    plan = jaccard.Plan()
    rng = np.random.default_rng(3)
    met = 0
    for _ in range(300):
        common = rng.integers(0, 2**63, 160).astype(np.uint64)
        a, b = (np.r_[common, rng.integers(0, 2**63, 20).astype(np.uint64)] for _ in range(2))
        met += bool(np.intersect1d(jaccard.chosen_paths(np.unique(a), plan), jaccard.chosen_paths(np.unique(b), plan)).size)
    assert met / 300 > 0.98 and plan.runs == 15


def test_sketches_follow_similarity():
    rng = np.random.default_rng(4)
    for share in (0.3, 0.8, 0.95):
        agree = []
        for _ in range(50):
            common = rng.integers(0, 2**63, 400).astype(np.uint64)
            rest = int(400 * (1 - share) / share / 2)
            s = [jaccard.sketch(np.unique(np.r_[common, rng.integers(0, 2**63, rest).astype(np.uint64)])) for _ in range(2)]
            agree.append(jaccard.agreement(s[0][None], s[1][None])[0, 0] / 128)
        assert abs(np.mean(agree) - (1 + share) / 2) < 0.03


@pytest.mark.parametrize("common, extra", [((4, 1)), ((8, 2)), ((8, 1)), ((16, 4)), ((24, 6)), ((40, 10)), ((400, 100))])
def test_sketches_lose_no_short_sets(common, extra):
    """Sets at 0.8 (a subset and its superset): nearly all pass the test of the sketches."""
    rng = np.random.default_rng(common)
    passed = 0
    for _ in range(400):
        whole = rng.integers(0, 2**63, common + extra).astype(np.uint64)
        a, b = jaccard.sketch(np.unique(whole[:common])), jaccard.sketch(np.unique(whole))
        passed += int(jaccard.agreement(a[None], b[None])[0, 0] >= jaccard.ALIKE)
    assert passed >= 398


def test_recall_by_number_of_shingles(spark):
    """Pairs at 0.8 or just above, of 4 to 45 shingles; at least 0.97 of each length are linked."""
    rng = random.Random(12)
    docs, lengths = [], {}
    for n in (4, 8, 12, 16, 28, 44):
        for _ in range(150):
            w = [f"w{rng.getrandbits(40)}" for _ in range(n + 4)]
            more = w + [f"w{rng.getrandbits(40)}" for _ in range(n // 4)]  # n of n + n / 4 shingles are common
            lengths.setdefault(n, []).append(len(docs))
            docs += [(len(docs), " ".join(w)), (len(docs) + 1, " ".join(more))]
    rows = {r["doc_id"]: r["n_links"] for r in jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    found = {n: sum(rows[i] == 1 for i in ids) / len(ids) for n, ids in lengths.items()}
    assert min(found.values()) >= 0.97, found


def test_large_buckets_connect_what_all_pairs_connect(monkeypatch):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**63, (6, 2)).astype(np.uint64)
    rows = []
    for k in range(900):  # drifting chains of sketches around some bases
        row = base[k % 6].copy() if k < 60 else rows[rng.integers(0, len(rows))].copy()
        for bit in rng.integers(0, 128, rng.integers(0, 20)):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        rows.append(row)
    sketches = np.array(rows)
    want = jaccard._grouped(sketches)
    monkeypatch.setattr(jaccard, "SMALL", 50)
    assert (jaccard._grouped(sketches) == want).all() and len(set(want.tolist())) > 1
    stand = jaccard.stand_ins(sketches)
    assert (stand[stand] == stand).all()
    assert all(jaccard.agreement(sketches[i : i + 1], sketches[j : j + 1])[0, 0] >= jaccard.SAME for i, j in enumerate(stand))


def test_a_chain_spread_over_batches_keeps_its_links(spark):
    """Each text changes one more word of the one before: ends are far apart, neighbours are linked."""
    rng = random.Random(3)
    w = [f"w{i}" for i in range(120)]
    docs = []
    for k in range(300):
        w = list(w)
        w[rng.randrange(120)] = f"x{k}"
        docs.append((k, " ".join(w)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = sorted((r["doc_id"], r["n_links"], r["component_id"], r["kept"]) for r in rows)
    want = brute(docs)
    links = lambda rows: sum(r[1] for r in rows)
    assert all(g[1] <= x[1] for g, x in zip(got, want)) and links(got) >= 0.98 * links(want)


def test_intersections():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 80, 40)).astype(np.uint64) for _ in range(60)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    np.fill_diagonal(want, 0)
    assert (jaccard.intersections(sets, None) == want).all()
    assert (jaccard.intersections(sets[:20], sets[20:]) == want[:20, 20:]).all()


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(300, 400)] + [(1, 2), (2, 3), (3, 1), (9, 9), (None, 4)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, Scratch(spark)).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(300, 400)} == {7}
    assert [got[i] for i in (1, 2, 3, 9)] == [1, 1, 1, 9] and None not in got
    assert components(df.limit(0), Scratch(spark)).count() == 0


def test_empty_and_kept_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(empty).count() == 0
    docs = spark.createDataFrame([(3, "a b c d e f"), (1, "A b c d e f"), (None, "other"), (2, None), (5, "")], "doc_id long, text string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and sorted(repr(r["doc_id"]) for r in kept.collect()) == ["1", "2", "5", "None"]


def test_rows_that_share_an_id_are_dropped_by_their_own_text(spark):
    rows = [(1, "a b c d e f"), (None, "A b c d e f"), (None, "something else of its own here"), (None, None), (7, "A b c d e f!"), (7, "yet another text that nobody repeats")]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(repr, kept)) == sorted(repr(r) for r in spark.createDataFrame([rows[k] for k in (0, 2, 3, 5)], "doc_id long, text string").collect())
