"""Personal data against plain regular expressions applied in Python."""

import hashlib
import re

import pytest

from nestmeans.llm import pii
from nestmeans.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def expected(text):
    return [
        (k, m.start(), m.end())
        for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])
    ]


HARD = [
    "", None, "a@b.c_x@d.e f@g", "..@x.y a@@b.c", "x@y.z@w.v", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0255 1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "5 4111111111111111", "4111  1111111111111",
    "4111111111111111-2", "+1 (446) 555-8962. +1234567 +12345678 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6", "+4111111111111111",
    "é€𝄞 mail a.b@c.de 𝄞 10.0.0.1", "9" * 20000, "1-" * 20000, "a" * 30000 + "@b.c", "1.2.3.4 " * 300,
    "+1 (446) 555-8962" * 3, "x@y.z" * 50, "0000 0000 0000 0000",
]


def test_hard_texts(spark):
    rows = spark.createDataFrame(list(enumerate(HARD)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["base"] for r in pii.scan(rows).collect()}
    for i, text in enumerate(HARD):
        assert [(s["kind"], s["start"], s["end"]) for s in got[i]] == expected(text), (i, text and text[:60])


def test_query_matches_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = QUERIES["op8_pii"](spark, DATA).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        want = expected(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"] == joined or r["spans"].startswith(joined)
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x[0] == k for x in want) for k in PLAIN]


def test_added_kinds_need_checksum_or_context(spark):
    texts = [
        "pay to DE89 3704 0044 0532 0130 00 now", "pay to DE89 3704 0044 0532 0130 01 now",
        "number 536-90-4399", "her ssn is 536-90-4399", "ssn 000-90-4399",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: [(s["kind"], s["score"]) for s in r["added"]] for r in pii.scan(rows).collect()}
    assert got[0] == [("iban", 0.9)] and got[1] == [] and got[2] == [] and got[4] == []
    assert got[3] == [("ssn", pytest.approx(0.65))]


def test_redact(spark):
    rows = spark.createDataFrame(
        [(1, "é a@b.cd and 1.2.3.4!", 5, "x"), (2, None, 0, "y"), (3, "clean", 99, None), (4, "+4111111111111111 z", 1, "")],
        "doc_id bigint, text string, n_chars bigint, base string",
    )
    got = {r["doc_id"]: r for r in pii.redact(rows).collect()}
    assert got[1]["text"] == "é [EMAIL] and [IP]!" and got[1]["n_chars"] == 19 and got[1]["base"] == "x"
    assert got[2]["text"] is None and got[2]["n_chars"] == 0
    assert got[3]["text"] == "clean" and got[3]["n_chars"] == 99
    assert got[4]["text"] == "+[CARD] z"


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id bigint, text string, n_chars bigint")
    assert pii.scan(rows).count() == 0 and pii.redact(rows).columns == rows.columns
