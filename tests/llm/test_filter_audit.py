import random
import re
from itertools import permutations

import numpy as np
import pytest

from vigil.llm import common
from vigil.llm import filter_audit as fa

COLUMNS = ["part", "filter_order", "step", *fa.FIGURES]
rnd = random.Random(5)


def fails(rows):
    out = []
    for i, t, part in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        same = [j for j, u, _ in rows if j is not None and (u or "") == t]
        out.append((i, part or "", {c for c, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search(r"[#$%&*|]", t) is not None, i is not None and any(j < i for j in same))) if bad}))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs, out = fails(rows), []
    for part in sorted({p for _, p, _ in docs}):
        mine = [(i, f) for i, p, f in docs if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = mine
            for step, c in enumerate(order, 1):
                gone = [(i, f) for i, f in left if c in f]
                left = [(i, f) for i, f in left if c not in f]
                shapley[c] += len(gone)
                found.append((c, (part, "".join(order), step, len(left), len(gone), sum(c in f for _, f in mine) - len(gone),
                                  sum(f == {c} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))))
        out += [(*row, shapley[c]) for c, row in found]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def text():
    words = [rnd.choice(["a", "Bee", "CCC", "word%d" % rnd.randrange(300), "é日", "x|y"][:rnd.choice([4, 5, 6])]) for _ in range(rnd.choice([5, 99, 100, 130]))]
    return rnd.choice([" ", "\t", "\x0b", "\x0c\r\n", "  "]).join(words)


ROWS = [(i, text(), rnd.choice(["en", "de", None, "EN"])) for i in range(120)]
ROWS += [(1000 + i, ROWS[rnd.randrange(9)][1], rnd.choice(["en", "de"])) for i in range(60)]
ROWS += [(None, None, None), (None, "", "en"), (None, ROWS[0][1], "de"), (-5, "", "en"), (7, None, "en"), ROWS[3], ROWS[3], (2000, "Q" * 70_000 + " z" * 90, "en"), (2001, "#", "only")]
LABELS = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(-10, 1050)] + [(None, 1, 1), (3, 1, 0), (3, 0, 1), (3, 1, 1)]


@pytest.mark.parametrize("range_rows, hot", [(1 << 18, 10_000), (5, 3)])
def test_against_brute_force(spark, monkeypatch, range_rows, hot):
    monkeypatch.setattr(common, "HOT_GROUPS", hot)
    docs = spark.createDataFrame([(*r, "x", 1, 0.5) for r in ROWS], "doc_id long, text string, lang string, part string, fails int, row double")
    labels = spark.createDataFrame([(*r, 9) for r in LABELS], "doc_id long, quality int, toxic int, good int")
    facts = fa.labelled(fa.failures(docs), labels)
    lists = fa.postings(facts, range_rows=range_rows)
    assert lists.agg({"n": "sum"}).first()[0] == len(ROWS)
    assert lists.selectExpr("max(n)").first()[0] <= range_rows
    assert rows_of(fa.in_all_orders(fa.interactions(lists))) == brute(ROWS, LABELS)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    assert rows_of(fa.audit(one, labels)) == brute([(1, None, None)], [])


def test_many_parts_are_flushed(spark, monkeypatch):
    monkeypatch.setattr(fa, "PARTS_HELD", 3)
    rows = [(i, "w " * (i % 3 * 60), f"p{i % 10}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rows_of(fa.audit(docs, labels)) == brute(rows, [])


def test_galloping():
    r = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.unique(r.integers(0, r.choice([10, 3000, 10**6]), r.choice([0, 1, 7, 600, 5000]))).astype(np.int32) for _ in range(2))
        assert (fa.found(a, b) == np.isin(a, b)).all()
        assert fa.shared(a, b) == len(np.intersect1d(a, b)) and (fa.merged(a, b) == np.union1d(a, b)).all()
