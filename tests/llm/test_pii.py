"""Personal data against the base patterns by brute force, the added kinds, and awkward rows."""
import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("keepwise.llm.queries")
from keepwise.llm import pii  # noqa: E402
from keepwise.llm.queries import QUERIES  # noqa: E402

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(kind, m[0])]
    return [(kind, s, e) for s, _, e, kind in sorted(found)]


def base(text):
    return [s for s in pii.personal_data(text) if s[0] in pii.BASE]


FIXED = ["", None, "a@b@c.de x@y.z@q.r .@-.- a@b. a@b..c ä@b.c é1@x.y", "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 001.2.3.4 1.2.3.4.", "+1 (132) 555-1352. +12 +1-2 ++49 30 123456789 +1((((((((",
         "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 41111111111111110000 9" * 2, "x" * 50 + "@" * 40 + "1" * 3000 + ".1.1.1", "٣٤@b.c ١.١.١.١",
         "4111 1111 1111 1111 5 a%b+c@mail.x-y.co.uk,d@e.f", "+" * 30 + "1 2345678901234567890", "10.0.0.1:80 4012888888881881 378282246310005"]


@pytest.mark.parametrize("text", FIXED)
def test_base_of_fixed_texts(text):
    assert base(text) == brute(text)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0123459 -.@+()aZ%_:/é\n", max_size=60))
def test_base_of_any_text(text):
    assert base(text) == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "+1 (132) 555-1352", "a.b@c.de", "10.0.0.1", "255.255.255.255.9", "378282246310005", " ", "-", ".", "@", "+", "IBAN ", "account: "]), max_size=12))
def test_base_of_joined_pieces(pieces):
    text = "".join(pieces)
    assert base(text) == brute(text)


@pytest.mark.parametrize("text, kind, span", [
    ("an jürgen@exämple.de bitte", "mail", "jürgen@exämple.de"), ("to bob@[10.0.0.1] now", "mail", "bob@[10.0.0.1]"),
    ("get https://bob:pa55@host.net:80/x?y", "login", "https://bob:pa55@host.net:80"), ("Phone: 030 1234567, x", "tel", "030 1234567"),
    ("IBAN: DE89 3704 0044 0532 0130 00 is", "iban", "DE89 3704 0044 0532 0130 00"), ("iban GB82WEST12345698765432.", "iban", "GB82WEST12345698765432"),
    ("my account number is 0012345678.", "account", "0012345678"), ("Konto Nr. 12345678 bei", "account", "12345678"),
    ("SSN 123-45-6789;", "ssn", "123-45-6789"), ("lives at 221B Baker Street, London", "street", "221B Baker Street"),
    ("wohnt Hauptstraße 12 in", "street", "Hauptstraße 12"), ("au 12, rue de la Paix", "street", "12, rue de la Paix"), ("en calle Mayor 7", "street", "calle Mayor 7")])
def test_added_kinds(text, kind, span):
    got = {(k, text[s:e]) for k, s, e in pii.personal_data(text)}
    assert (kind, span) in got
    assert base(text) == brute(text)


@pytest.mark.parametrize("text", ["IBAN DE89 3704 0044 0532 0130 01", "ssn 000-12-3456", "ssn 123-45-67890", "the account of 2019", "a street of 12 Trees", "see http://host/a@b",
                                  "accountable 12345678", "telling 1234567", "la rue est longue", "mail: a @ b.de", "phone 12"])
def test_clean_texts(text):
    assert pii.personal_data(text) == []


def test_linear_time_on_long_runs():
    import time
    for unit in ("1", "1.", "a@", "+1 ", "a.", "1-", "@", "straße ", "://", "iban A"):
        took = []
        for n in (20_000, 200_000):
            text = unit * n
            start = time.perf_counter()
            pii.personal_data(text)
            took.append(time.perf_counter() - start)
        assert took[1] < 40 * took[0] + 0.5, unit


def test_redaction():
    text = "a b@c.de, +1 (132) 555-1352 and 10.0.0.1"
    assert pii.redacted(text, pii.personal_data(text)) == "a <email>, <phone> and <ip>"
    assert pii.redacted(None, []) is None


def test_digests(spark, sf_dir):
    rng = random.Random(4)
    rows = [(i if i != 3 else None, t) for i, t in enumerate([*FIXED, *FIXED[:4], " ".join(rng.choices(["4111 1111 1111 1111", "a@b.de", "word", "+1 (132) 555-1352"], k=40_000))])]
    frame = spark.createDataFrame([(*r, None, None, None) for r in rows], "doc_id long, text string, spans string, kind int, redacted int")
    got = Counter(tuple(r) for r in pii.span_digests(pii.find_personal_data(frame)).collect())
    want = Counter()
    for i, t in rows:
        spans = brute(t)
        counts = [sum(s[0] == k for s in spans) for k in pii.BASE]
        want[(i, *counts, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest(), ",".join(f"{k}:{s}:{e}" for k, s, e in pii.personal_data(t)))] += 1
    assert got == want
    assert pii.find_personal_data(frame.filter("false")).count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op11_pii"](spark, sf_dir).collect():
        spans = brute(docs[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in pii.BASE)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
