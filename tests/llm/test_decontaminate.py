import re
from collections import Counter

import numpy as np

from vigil.llm import decontaminate as dc
from vigil.sources.tables import table

SF0001 = "/root/testdata/sf0.001"


def brute(docs, items, shingle=5, threshold=0.8):
    """Best window of each text and item by trying every window."""
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    out = {}
    for i, item in items:
        w = words(item)
        if not w:
            continue
        k = min(shingle, len(w))
        have = Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
        size = sum(have.values())
        for d, text in docs:
            x = words(text)
            runs = [tuple(x[j:j + k]) for j in range(len(x) - k + 1)]
            m = min(size, len(runs))
            for s in range(len(runs) - m + 1 if m else 0):
                if runs[s] not in have and runs[s + m - 1] not in have and not any(r in have for r in runs[s:s + m]):
                    continue
                window = Counter(runs[s:s + m])
                both = sum((window & have).values())
                sim = both / (m + size - both)
                if sim >= threshold and ((d, i) not in out or sim > out[d, i][0]):
                    out[d, i] = (sim, s, m + k - 1)
    return out


def found(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, id string")
    return {(r.doc_id, r.item_id): (r.similarity, r.first_word, r.n_words) for r in dc.find(d, b, **more).collect()}


def test_matches_brute_force_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF0001, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF0001, "benchmark").collect()]
    want = brute(docs, items)
    assert found(spark, docs, items) == want and want
    assert found(spark, docs, items, block_items=7) == want


def test_edited_passages_match_brute_force(spark):
    rnd = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocabulary, rnd.integers(15, 60)))) for i in range(20)] + [(20, "only four words here"), (21, None), (22, " "), (23, "")]
    docs = [(100, None), (101, ""), (102, "w1"), (103, "x " * 20000), (104, "we say ONLY four\twords here now")]
    for i, t in items[:20]:
        for n, edits in enumerate((0, 1, 1, 2, 3)):
            w = t.split()
            for _ in range(edits):
                at = int(rnd.integers(len(w)))
                w = w[:at] + [["zzz"], [], ["zz", w[at]]][int(rnd.integers(3))] + w[at + 1:]
            around = " ".join(rnd.choice(vocabulary, 40))
            docs.append((1000 + 10 * i + n, f"{around} {' '.join(w)} {around}" if n != 2 else " ".join(w)))
    want = brute(docs, items)
    assert found(spark, docs, items) == want and len(want) >= 40


def test_repeated_shingles_match_brute_force(spark):
    rnd = np.random.default_rng(6)
    items, docs = [], []
    for i, size in enumerate((54, 94, 204, 304, 60, 120)):
        w = [f"v{i}x{j}" for j in range(size)]
        if i > 3:  # an item with repeated lines
            w = w[:size // 2] + w[:4] * 8 + w[size // 2:]
        items.append((i, " ".join(w)))
        for n, (part, run) in enumerate(((0.93, "-"), (0.92, "x"), (0.91, "-"), (0.92, "- x"), (0.7, "-"))):  # cut short, then a run
            cut = w[:int(part * len(w))]
            tail = (run.split() * len(w))[:len(w)]
            around = [f"u{x}" for x in rnd.integers(0, 10**6, 30)]
            docs += [(100 * i + n, " ".join(cut + tail)), (100 * i + 10 + n, " ".join((tail + cut)[-len(w):])), (100 * i + 20 + n, " ".join(around + cut + tail + around))]
    docs.append((1000, "- " * 3000 + items[1][1] + " -" * 3000))
    want = brute(docs, items)
    assert found(spark, docs, items) == want and len(want) > 40


def test_best_window_matches_counting():
    rnd = np.random.default_rng(7)
    for _ in range(300):
        text = rnd.integers(0, 6, rnd.integers(1, 40))
        item = rnd.integers(0, 6, rnd.integers(1, 15))
        index = dc.Index([(0, " ".join(f"w{x}" for x in item).encode())], 1)
        runs = dc.Index([(0, " ".join(f"w{x}" for x in text).encode())], 1).runs[0]
        places = np.flatnonzero(np.isin(text, item))
        size, have = min(len(item), len(text)), Counter(item.tolist())
        if len(places):
            sums = [sum((Counter(text[s:s + size].tolist()) & have).values()) for s in range(len(text) - size + 1)]
            assert index.best_window(runs, places, 0) == (max(sums) / (size + len(item) - max(sums)), sums.index(max(sums)))


def test_block_tables_miss_none_within_the_radius():
    rnd = np.random.default_rng(4)
    index = dc.Index([(i, " ".join(f"a{x}" for x in rnd.integers(0, 10**6, 30)).encode()) for i in range(200)], 5)
    for n in range(200):
        bits = np.unpackbits(index.prints[n])
        bits[rnd.choice(64, dc.RADIUS, replace=False)] ^= 1
        assert n in index.within(np.packbits(bits)[None], n)[0]


def test_remove_keeps_clean_rows_and_columns(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, "x", f"so {item} it is"), (2, "y", None), (None, "z", "clean"), (2, "y", None)], "doc_id long, id string, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(map(str, dc.remove(docs, items).collect())) == sorted(map(str, docs.where("doc_id is null or doc_id = 2").collect()))
    assert dc.remove(docs, items.limit(0)).count() == 4 and dc.find(docs, items.limit(0)).count() == 0
    assert dc.remove(docs.limit(0), items).count() == 0


def test_recall_just_above_the_threshold(spark):
    rnd = np.random.default_rng(8)
    items = [(i, " ".join(f"v{x}" for x in rnd.choice(100_000, 50, replace=False))) for i in range(60)]  # 46 shingles
    docs = []
    for i, t in items:
        for n in range(8):
            w = t.split()
            w[int(rnd.integers(4, 46))] = f"other{n}"  # five shingles go: 41 of 51
            docs.append((1000 + 8 * i + n, " ".join([*("before " * int(rnd.integers(0, 9))).split(), *w, "after"])))
    want = brute(docs, items)
    assert len(want) == len(docs) and all(0.8 <= s < 0.81 for s, _, _ in want.values())
    got = found(spark, docs, items)
    assert got.items() <= want.items() and len(got) >= 0.995 * len(want)


def test_blocks_are_files_and_lose_nothing(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(60)] + [(60, ""), (None, "a null id of five words"), (5, " ".join(f"w5x{j}" for j in range(12)))], "item_id long, text string")
    docs = spark.createDataFrame([(i, "before " + " ".join(f"w{i}x{j}" for j in range(12)) + " after") for i in range(80)], "doc_id long, text string")
    names = dc._blocks(items, "item_id", "text", 5, 10)
    assert len(names) > 3 and all(n.endswith(".pickle") for n in names)
    whole, cut = ({(r.doc_id, r.item_id, r.similarity) for r in dc.find(docs, items, block_items=n).collect()} for n in (1000, 10))
    assert whole == cut and {d for d, _, _ in cut} == set(range(60))
    assert {r.doc_id for r in dc.remove(docs, items, block_items=10).collect()} == set(range(60, 80))
    assert dc._blocks(items.limit(0), "item_id", "text", 5, 10) == []
