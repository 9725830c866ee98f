import re

import numpy as np

from vigil.llm import minhash as mh


def brute(rows, k, percent=80):
    sets = {}
    for i, t in rows:
        if i is None or i in sets:
            continue
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), i == find(i)) for i in sets}


def found(spark, rows, k=5):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, id int, component_id string")
    return {r.id: (r.n_shingles, r.component_id, r.kept) for r in mh.near_duplicates(df, shingle=k).collect()}


def test_families_of_edited_copies_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mh, "BLOCK", 16)
    rnd = np.random.default_rng(11)
    rows, n = [], 0
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(int(rnd.integers(60, 200)))]
        for _ in range(40):
            w = list(base)
            for _ in range(int(rnd.integers(0, 9))):
                w[int(rnd.integers(len(w)))] = f"e{n}x{rnd.integers(1000)}"
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n + i, " ".join(f"u{i}_{j}" for j in range(30)) + " shared line of words that many texts hold") for i in range(60)]
    for k in (4, 5):
        assert found(spark, rows, k) == brute(rows, k)


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one\ttwo"), (6, "two one"), (9, long), (7, long + " more"), (8, "x" * 9000), (11, "x" * 9000),
            (None, "one two"), (4, "One two"), (-5, "ONE  TWO"), (12, "é É"), (13, "É é"), (14, "a b c d e"), (15, "a b c d e")]
    assert found(spark, rows) == brute(rows, 5)
    assert found(spark, []) == {}


def test_pruning_keeps_its_promise():
    import math

    fewest = mh.fewest_matches(80, 1e-5)
    assert list(fewest) == sorted(fewest)
    for n, m in zip(range(mh.STEP, mh.CHECKS + 1, mh.STEP), fewest):
        tail = sum(math.comb(n + 1, j) * 0.8**j * 0.2 ** (n + 1 - j) for j in range(m))
        assert tail < 1e-5
    same = np.arange(mh.CHECKS, dtype=np.uint16)[None]
    assert len(mh.surviving(same, same, fewest)[0]) == 1 and len(mh.surviving(same, same + 1, fewest)[0]) == 0


def test_word_hashes_follow_the_words():
    from vigil.llm.shingles import word_hashes

    texts = [b"a bb  a", b"", b" ", b"A\tBB", "é É".encode(), b"y" * 5000 + b" " + b"y" * 5001, b"y" * 5000]
    h, at = word_hashes(texts)
    words = [re.findall(rb"[^\x20\x09-\x0D]+", t.lower()) for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    by_word = {}
    for w, x in zip([w for ws in words for w in ws], h.tolist()):
        assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)
