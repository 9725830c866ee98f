import numpy as np

from vigil.llm import hnsw


def brute(rows, threshold=0.9):
    best = {}
    for i, v in rows:
        if i is not None:
            key = (v is not None, [(c is not None, c) for c in v or []])
            if i not in best or best[i][1] is None or (v is not None and key < best[i][0]):
                best[i] = (key, v)
    vs = {i: v for i, (_, v) in best.items()}
    sound = {i: np.array(v, float) for i, v in vs.items() if v and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    parent = {i: i for i in vs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = dict.fromkeys(vs, 0)
    ids = sorted(sound)
    for a in ids:
        for b in ids:
            x, y = sound[a], sound[b]
            if a < b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                n[a] += 1
                n[b] += 1
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (n[i], find(i), i == find(i)) for i in vs}


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1) for i, v in rows],
                               "vec_id long, embedding array<double>, shard int")
    return {r.id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(df, **more).collect()}


def all_hits(graph, queries, beam):
    return [np.concatenate(x) for x in list(zip(*hnsw._hits(graph, queries, 0.9, beam)))[:2]]


def test_forest_of_pieces():
    rnd = np.random.default_rng(3)
    for n, m in ((1, 0), (50, 30), (400, 900), (3000, 2000)):
        parent, slow = np.arange(n), list(range(n))
        for _ in range(3):
            a, b = rnd.integers(0, n, (2, m))
            hnsw._join(parent, a, b)
            for x, y in zip(a.tolist(), b.tolist()):
                low, high = sorted((slow[x], slow[y]))
                slow = [low if s == high else s for s in slow]
        assert hnsw._roots(parent, parent).tolist() == slow


def clustered(rnd, n, dim=16):
    rows = [(i, rnd.standard_normal(dim)) for i in range(n)]
    rows += [(n + i, rows[int(rnd.integers(n))][1] + 0.05 * rnd.standard_normal(dim)) for i in range(n // 3)]
    centre = rnd.standard_normal(dim)
    rows += [(3 * n + i, centre + 0.02 * rnd.standard_normal(dim)) for i in range(n // 2)]  # a large group
    rows += [(5 * n + i, rows[7][1].copy()) for i in range(n // 4)]  # equal vectors
    return [(i, v.tolist()) for i, v in rows]


def test_links_and_components_match_brute_force(spark):
    rows = clustered(np.random.default_rng(1), 240)
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, shards=2, shard_rows=100, block_rows=90) == want


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [2.0, 0.0]),
            (10, [1.0, 0.48432]), (11, [1.0, 0.48433]), (12, [-1.0, 0.0]), (13, [1e-30, 0.0]), (14, [-0.0, 5.0]), (15, [0.0, 7.0]),
            (None, [1.0, 0.0]), (9, [2.0, 0.0]), (16, [1e30, 1e30])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == {}
    assert found(spark, [(1, None)]) == {1: (0, 1, True)}
    assert found(spark, [(5, [1.0, 2.0])]) == {5: (0, 5, True)}


def test_beams_widen_until_the_audit_passes():
    rnd = np.random.default_rng(0)
    x = rnd.standard_normal((3000, 48))
    x[1000:1400] = x[0] + 0.05 * rnd.standard_normal((400, 48))
    graph = hnsw.Graph.build(np.arange(3000), np.ones(3000, int), x)
    q = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    beam, recall = hnsw.audited_beam(graph, q, 0.9)
    assert recall >= hnsw.RECALL
    a, p = all_hits(graph, q, beam)
    truth = set(zip(*(t.tolist() for t in np.nonzero(q @ q.T >= 0.9 - hnsw.SLACK))))
    got = set(zip(a.tolist(), p.tolist()))
    assert got <= truth and len(got) >= 0.99 * len(truth)
    again = hnsw.Graph.unpacked(graph.packed())
    assert np.array_equal(again.search(q[:50], 32)[0], graph.search(q[:50], 32)[0])
    # the audit itself: links cut away make the beam grow
    poor = hnsw.Graph(graph.ids, graph.many, graph.exact, graph.x, [(m, np.where(rnd.random(g.shape) < 0.85, -1, g)) for m, g in graph.layers])
    assert hnsw.audited_beam(poor, q, 0.9)[0] > beam


def test_a_large_group_hides_no_missed_pairs():
    rnd = np.random.default_rng(2)
    x = rnd.standard_normal((3000, 48))
    x[:1000] = x[0] + 0.03 * rnd.standard_normal((1000, 48))  # a third near copies
    x[2000:] = x[1000:2000] + 0.1 * rnd.standard_normal((1000, 48))  # scattered pairs
    graph = hnsw.Graph.build(np.arange(3000), np.ones(3000, int), x)
    q = graph.x.copy()
    (lowest, links), levels = graph.layers[-1], graph.layers[:-1]
    levels = [*levels, (lowest, np.where((links >= 1000) | (lowest[:, None] >= 1000), -1, links))]
    poor = hnsw.Graph(graph.ids, graph.many, graph.exact, graph.x, levels)  # only the group is linked
    for more in ({}, {"ids": graph.ids}):
        beam, recall = hnsw.audited_beam(poor, q, 0.9, **more)
        a, p = all_hits(poor, q, beam)
        pairs = {(i, j) for i, j in zip(a.tolist(), p.tolist()) if i >= 1000 and i != j}
        want = {(i, j) for i, j in zip(*(t.tolist() for t in np.nonzero(q @ q.T >= 0.9))) if i >= 1000 and i != j}
        assert beam > hnsw.BEAM and recall >= hnsw.RECALL and len(want) > 1900 and len(pairs & want) >= 0.99 * len(want)
