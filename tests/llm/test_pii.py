"""Personal data against plain searches by the contract's own patterns."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from areacast.llm import pii
from areacast.llm.common import importable
from areacast.llm.queries import ORACLE_SQL

CARD = "4111 1111 1111 1111"
IBAN = "DE89 3704 0044 0532 0130 00"
TEXTS = [
    (1, "Write to a.b+c@mail.example.com or @x.y, x@y, a@b.c@d.e, q@w..e"), (2, None), (3, ""),
    (4, "ip 10.0.0.255 and 1.2.3.4.5.6.7.8 or 256.1.1.1, 1.2.3, 0255.01.1.1, 1.2.3.4.5"),
    (5, f"card {CARD}, 4111-1111-1111-1112, {CARD}9999 and 5 5500 0000 0000 0004"),
    (6, "+49 (30) 1234-5678. +1 2, +123456789012345678 +1-800.555.0199 (x)"),
    (7, f"Zahlen an Konto {IBAN}. DE88 3704 0044 0532 0130 00 is wrong; GB82WEST12345698765432"),
    (8, "his SSN is 123-45-6789, 666-45-6789; call 555 123 4567"), (9, "no word near: 123-45-6789 and 555 123 4567"),
    (10, "order: call 555 123 4567"), (11, "é\U0001f600 ü x@y.zz \U0001f600 10.1.2.3"), (11, "é\U0001f600 ü x@y.zz \U0001f600 10.1.2.3"),
    (None, "10.1.2.3"), (12, "a" * 100_000 + "@" + "b" * 100_000 + ".c" + "9" * 100_000 + ".1.2.3 +" + " (" * 50_000), (13, "@a.b " * 5000),
]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame([(i, t, "own", 7, 0.5) for i, t in TEXTS], "doc_id long, text string, pii string, spans int, score double")


def plain_luhn(number):
    total = 0
    for place, digit in enumerate(reversed(number)):
        d = int(digit) * (2 if place % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    """The contract's words, one after the other."""
    found = []
    for k, (kind, pattern) in enumerate((
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )):
        for m in re.finditer(pattern, text or ""):
            number = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(number) <= 19 and plain_luhn(number)):
                continue
            if kind == "phone" and not 9 <= len(number) <= 15:
                continue
            found.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x for *_, x in sorted(found)]


def base_of(text):
    return [f"{x.kind}:{x.start}:{x.end}" for x in pii.find(text) if x.kind in pii.BASE]


def test_base_spans_equal_the_plain_search():
    for i, text in TEXTS:
        if i != 12:  # the plain patterns need quadratic time there
            assert base_of(text) == plain_base(text), i
    r = random.Random(11)
    pieces = ["a", "Z", "@", ".", "-", "+", " ", "(", ")", "1", "22", "0", "411", "@a.b", "1.2.3.4", "é", "\n", "_", "%", "4111 1111 1111 1111", "10.0.0.", "+49 ", "5"]
    for _ in range(20_000):
        text = "".join(r.choices(pieces, k=r.randint(1, 14)))
        assert base_of(text) == plain_base(text), text


def test_long_runs_take_linear_time():
    found = pii.find(dict(TEXTS)[12])
    assert [x.kind for x in found] == ["email"] and found[0].end > 300_000


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97(IBAN.replace(" ", "")) and not pii.mod97("DE88370400440532013000")
    r = random.Random(3)
    for _ in range(300):
        number = "".join(r.choices("0123456789", k=r.randint(12, 19)))
        assert pii.luhn(number) == plain_luhn(number)


def test_context_moves_the_score():
    assert [x.kind for x in pii.find(dict(TEXTS)[8])] == ["ssn", "local_phone"]
    assert pii.find(dict(TEXTS)[9]) == [] and pii.find(dict(TEXTS)[10]) == []
    assert [x.kind for x in pii.find(dict(TEXTS)[7])] == ["iban", "iban"]
    near, far = pii.find("iban " + IBAN)[-1], pii.find(IBAN)[-1]
    assert near.score == 1.0 and far.score == 0.9
    # A weak kind gives way to a base span over it.
    assert [x.kind for x in pii.find("call +1 555 123 4567")] == ["phone"]


def test_query_digests(spark, docs):
    got = pii.pii_spans(docs).collect()
    assert len(got) == len(TEXTS)
    want = []
    for i, text in TEXTS:
        spans = pii.find(text)
        base = base_of(text) if i == 12 else plain_base(text)
        own = [sum(x.startswith(k) for x in base) for k in pii.BASE]
        want.append((i, *own, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(f"{x.kind}:{x.start}:{x.end}" for x in spans)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert pii.pii_spans(docs.where("false")).count() == 0


def test_against_duckdb(docs):
    db, docs = duckdb.connect(), docs.where("not doc_id <=> 12")  # its patterns are slow on the long runs
    db.register("documents", docs.select("doc_id", "text").toArrow())
    want = db.sql(ORACLE_SQL["op11_pii"]).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in pii.pii_spans(docs).collect())


def test_operator_keeps_other_columns(docs):
    out = pii.find_pii(docs)
    assert out.columns == ["doc_id", "text", "spans", "score", "pii"]
    assert {(r.spans, r.score) for r in out.collect()} == {(7, 0.5)}
    masked = {r.doc_id: r.text for r in pii.redact(docs).where(F.col("doc_id").isin(2, 8, 11)).collect()}
    assert masked == {2: None, 8: "his SSN is <ssn>, 666-45-6789; call <local_phone>", 11: "é\U0001f600 ü <email> \U0001f600 <ip>"}
