import hashlib
import random
import re
import time

import pytest

from vacantia.llm import pii, registry

SF = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value // 10 + value % 10
    return total % 10 == 0


def brute(text):
    """Base spans by the regular expressions that define them."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    return [(kind, *m.span()) for kind, (pattern, ok) in tests.items() for m in re.finditer(pattern, text) if ok(m)]


def test_query_against_the_expressions(spark):
    rows = {r.doc_id: r for r in registry.QUERIES["op7_pii"](spark, SF).collect()}
    total = 0
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        want, row = brute(text), rows[doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in want) for k in pii.BASE]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert row.spans.startswith(joined)
        total += len(want)
    assert total > 30


def test_random_texts_agree_with_the_expressions():
    draw = random.Random(2)
    bits = ["1", "2", "9", "25", "4111 1111 1111 1111", "10.0.0.1", ".", "-", " ", "@", "a", "b.c", "+", "(", ")", "é", "://", "%", "0000000", "x=", "\n"]
    for _ in range(30_000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(0, 14)))
        assert [s for s in pii.find_spans(text) if s[0] in pii.BASE] == brute(text), text


@pytest.mark.parametrize("bit", ["1", "1.", "a@", "+1", "1 ", "://", "a", "password=", "9-"])
def test_hostile_texts_take_linear_time(bit):
    began = time.perf_counter()
    pii.find_spans(bit * 200_000)
    assert time.perf_counter() - began < 5


def test_cues_add_logins_and_accounts_only():
    found = lambda t: [(k, t[s:e]) for k, s, e in pii.find_spans(t)]
    assert found("see ftp://joe:pw@host.org/x") == [("email", "pw@host.org"), ("login", "ftp://joe:pw@host.org")]
    assert found('token = "ab12cd34ef"; Password: hunter2222') == [("account", "ab12cd34ef"), ("account", "hunter2222")]
    assert found("the account of a password is secret, see http://host.org/a@b") == []


def test_masking(spark):
    rows = [(1, "mail a.b@c.org or +1 (555) 555-1234."), (2, None), (3, ""), (4, "clean text"), (4, "clean text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = [r.text for r in pii.mask(df).orderBy("doc_id").collect()]
    assert out == ["mail [EMAIL] or [PHONE].", None, "", "clean text", "clean text"]
    clash = pii.find(df.selectExpr("doc_id", "text", "1 AS spans")).orderBy("doc_id").collect()
    assert [len(r.spans) for r in clash] == [2, 0, 0, 0, 0]
    assert pii.find(df.where("false")).count() == 0
