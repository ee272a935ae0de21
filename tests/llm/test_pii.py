import hashlib
import random
import re

from edge import ROWS, docs, empty

from pickwise.llm import pii
from pickwise.llm.queries import op1_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, span):
    digits = [int(c) for c in span if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in span.split("."))
    if kind == "card":
        doubled = [d if n % 2 == 0 else sum(divmod(2 * d, 10)) for n, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), n, kind, m.end())
        for n, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def expected(doc_id, text):
    spans = brute(text)
    line = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    counts = [sum(x[0] == kind for x in spans) for kind in PATTERNS]
    return (doc_id, *counts, hashlib.sha256(line.encode()).hexdigest())


def test_base_spans_as_the_patterns():
    rng = random.Random(5)
    for alphabet in ("0123456789 -.+()@a", "a@.b-1", "12. +-", "4 -", "😀a@b.c1 "):
        for _ in range(5000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
            assert [x[:3] for x in pii.find(text) if x[3]] == brute(text), text


def test_added_kinds():
    text = "at 12 Old Mill Road, IBAN GB82 WEST 1234 5698 7654 32 account no. 1234567 http://bob:pw@host.x/"
    found = {kind: text[start:end] for kind, start, end, base in pii.find(text) if not base}
    assert found == {
        "address": "12 Old Mill Road", "iban": "GB82 WEST 1234 5698 7654 32",
        "account": "1234567", "login": "bob:pw",
    }
    assert pii.find("Road works, account of 12345, GB83 WEST 1234 5698 7654 32, a://b") == []


def test_long_texts_are_linear():
    for text in ("1." * 200_000, "@" * 400_000, "a" * 400_000 + "@", "+1 " * 150_000, "1 " * 200_000):
        pii.find(text)


def test_edge_rows(spark):
    got = pii.digests(pii.find_personal_data(docs(spark, ROWS)))
    assert sorted(repr(tuple(r)[:6]) for r in got.collect()) == sorted(
        repr(expected(*row)) for row in ROWS
    )
    assert pii.find_personal_data(empty(spark)).count() == 0


def test_query_as_the_patterns(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = op1_pii(spark, sf_dir).collect()
    assert sorted(tuple(r)[:6] for r in got) == sorted(expected(*row) for row in given)
