import hashlib
import re

import numpy as np
import pytest

from vigil.llm import pii
from vigil.sources.tables import table

SF001 = "/root/testdata/sf0.01"


def brute(text):
    """The base kinds by plain regular expressions."""
    text, out = text or "", []

    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0

    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


TRICKY = [None, "", "a@b", "a@b.c", "x@a.b_d@e.f", "a@@b.c", "@b.c", "a@b..c", "a.b@c.d.e.", "x@y.z@w.v", "1.2.3.4.5.6.7.8", "1.2.3.256 0001.2.3.4",
          "300.1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "+1 (212) 555-0100.", "+12", "+1 22 33 44 55 ", "é +49 30 1234567é",
          "++1.2.3.4+5 6", "9" * 5000, "a" * 5000, "a" * 3000 + "@" + "b" * 3000 + ".c", "mail bob at example dot com", "5" * 20]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans_match_brute_force(text):
    assert pii.base_spans(text or "") == brute(text)


def test_random_texts_match_brute_force():
    import random

    rnd = random.Random(5)
    for _ in range(4000):
        text = "".join(rnd.choice("a1.@-+ (9)%_é4") for _ in range(rnd.randint(0, 60)))
        assert pii.base_spans(text) == brute(text), text


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(table(spark, SF001, "documents"))


def test_query_matches_brute_force(spark, model):
    from vigil.llm.queries import QUERIES

    want = {r.doc_id: brute(r.text) for r in table(spark, SF001, "documents").collect()}
    for r in QUERIES["op7_pii"](spark, SF001).collect():
        spans = want[r.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for _, k, _ in spans) for n in range(4))
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_model_adds_and_declines(model):
    text = 'call (212) 555-0147 today; token = "9f8a7b6c5d4e3f2a1b0c9d8e7f6a5b4c" and the plain words stay'
    base, more = pii.find_spans(text, model)
    assert base == [] and {pii.KINDS[k] for _, k, _ in more} & {"secret", "phone"}
    assert pii.find_spans("nothing to see in these plain words", model) == ([], [])
    assert pii.find_spans(text, None) == ([], [])


def test_long_secrets_are_whole(spark, model):
    secret = "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(40))
    for size in (200, 256, 257, 300, 301, 2560):
        for text in (f'token = "{secret[:size]}" and more', f"api_key:{secret[:size]}"):
            at = text.index(secret[:8])
            assert (at, 6, at + size) in pii.loose_spans(text)
            s, before, after = pii._around(text, at, at + size)
            assert pii.checked(6, s, before) and float(size) in pii.features(6, s, before, after)
    yes = pii.Model(*(np.array([x]) for x in (-1, 0.0, 0, 0, 5.0)), np.array([0]), 0.5)
    for use in (yes, model):
        df = spark.createDataFrame([(1, f"password and secret token={secret} end")], "doc_id long, text string")
        assert pii.redact(df, use).first().text == "password and secret token=<SECRET> end"


def test_redaction_and_edge_cases(spark, model):
    rows = [(1, "x", "write a@b.com or +1 (212) 555-0100 now"), (2, "y", None), (3, "z", ""), (None, "w", "ip 1.2.3.4"), (3, "z", "")]
    df = spark.createDataFrame(rows, "doc_id long, found string, text string")
    got = sorted(((r.doc_id, r.found, r.text) for r in pii.redact(df, None).collect()), key=str)
    assert got == sorted([(1, "x", "write <EMAIL> or <PHONE> now"), (2, "y", None), (3, "z", ""), (None, "w", "ip <IP>"), (3, "z", "")], key=str)
    assert pii.scan(df, model).count() == 5
    empty = df.limit(0)
    assert pii.train(empty) is None and pii.scan(empty, None).count() == 0


def test_every_document_is_learnt_from(spark, monkeypatch):
    kept = []
    plain = pii.materialize
    monkeypatch.setattr(pii, "materialize", lambda df, name: kept.append(plain(df, name)) or kept[-1])
    n = 24_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('host 10.0.', id % 3, '.7 answers') AS text")
    assert pii.train(docs) is not None
    # an address and its spoiled copy each; equal ones are one row with their number
    assert kept[0].agg({"n": "sum"}).first()[0] == 2 * n and kept[0].count() < 100
