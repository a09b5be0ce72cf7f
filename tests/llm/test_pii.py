"""PII spans against Python's own matching of the plain patterns."""

import hashlib
import random
import re

import pytest

from millrace.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return {
        k: [(m.start(), m.end()) for m in re.finditer(p, text or "") if valid(k, m.group())] for k, p in PLAIN.items()
    }


CASES = [
    None,
    "",
    "mail a@b.c_x@d.e, ü@x.de and ñandú a.b+c%d@ex-am.ple.com.",
    "1.2.3.4.5 256.1.1.1 0255.00000.1.007 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 and 41111111111111111111 5- 4111111111111111",
    "+1 (737) 555-3887 of, +49.30 1234-5 () +1-2 +123456789012345678",
    "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 but DE88370400440532013000",
    'token = "fe556ffed5ef8e0fe135" password=dec922b87c1555881a password: short',
    "😀 x@y.zz " * 50,
    "a" * 20_000 + "@" + "b." * 9_000 + "c",
    "1" * 30_000,
]


def fuzz(n):
    rng = random.Random(7)
    pieces = ["4111111111111111", "1.2.3.4", "+1 555", "a@b.c", "@", ".", " ", "-", "7", "(", "é", "\n", "_", "..", "0.0"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def test_matches_plain_patterns(spark):
    texts = CASES + fuzz(1500)
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, email int")
    rows = {r["doc_id"]: r for r in pii.digest(pii.find_pii(docs)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        want = brute(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, spans in want.items() for a, b in spans)
        assert [rows[i][f"n_{k}"] for k in PLAIN] == [len(s) for s in want.values()], repr(text)[:200]
        assert rows[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert rows[i]["spans"].startswith(listed)


def test_method_adds_checked_kinds(spark):
    texts = ["pay to DE89 3704 0044 0532 0130 00 or DE88 3704 0044 0532 0130 00", "my ssn 123-45-6789", "part 123-45-6789"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.find_pii(docs).collect()}
    assert [(s["start"], s["end"]) for s in rows[0]["iban"]] == [(7, 34)]
    assert len(rows[1]["ssn"]) == 1 and rows[1]["ssn"][0]["score"] == pytest.approx(0.7)
    assert rows[2]["ssn"] == []


def test_context_raises_the_score(spark):
    docs = spark.createDataFrame([(0, "call +1 555 123 4567"), (1, "take +1 555 123 4567")], "doc_id long, text string")
    scores = {r["doc_id"]: r["phone"][0]["score"] for r in pii.find_pii(docs).collect()}
    assert scores[0] > scores[1]


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a@b.c"), (None, "a@b.c")], "doc_id long, text string")
    assert [r["n_email"] for r in pii.digest(pii.find_pii(docs)).collect()] == [1, 1]
    assert pii.find_pii(docs.limit(0)).count() == 0
