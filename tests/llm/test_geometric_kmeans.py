import hashlib
import math

import numpy as np
import pytest

from vigil.llm import geometric_kmeans as gk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, dim, k, rounds):
    good = [(i, [math.floor(1024 * float(np.float32(e))) for e in v]) for i, v in rows if v is not None and len(v) == dim and all(e is not None and math.isfinite(e) for e in v)]
    first = sorted(good, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    cents = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in good]
        cents = [[sum(x) // len(m) for x in zip(*m)] if (m := [v for (_, v), o in zip(good, of) if o == j]) else c for j, c in enumerate(cents)]
    got = [(i, near(v)) for i, v in good]
    return sorted(((i, j, d, sum(e for _, (e, o) in got if o == j), sum(e for _, (e, _) in got),
                    hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, (d, j) in got), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def cloud(n, dim, seed, spread=1.0):
    r = np.random.default_rng(seed)
    middles = r.normal(0, 1, (12, dim))
    return [(i, (middles[r.integers(12)] + r.normal(0, spread, dim)).tolist()) for i in range(n)]


@pytest.mark.parametrize("dim, k, rounds, spread", [(64, 8, 10, 0.3), (3, 5, 10, 1.0), (2, 8, 25, 0.05), (64, 1, 2, 1.0)])
def test_against_brute_force(spark, dim, k, rounds, spread):
    rows = cloud(500, dim, dim + k, spread) + [(None, [0.5] * dim), (None, None), (1000, None), (1001, [0.1]), (1002, [None] + [0.1] * (dim - 1)),
                                               (1003, [math.nan] * dim), (1004, [math.inf] * dim), (7, [0.0] * dim), (8, [-0.0] * dim)]
    rows += [(2000 + i, [0.25] * dim) for i in range(200)] + rows[:3]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", id int, cluster string")
    assert rows_of(gk.cluster(df, dim=dim, k=k, rounds=rounds, shard_bytes=dim * 4 * 64)) == brute(rows, dim, k, rounds)


def test_ties_few_vectors_and_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [float(i % 2), 0.0]) for i in range(40)], [(i, [1.0, 1.0]) for i in range(20)], [(None, [1.0, 0.0]), (None, [0.0, 0.0])]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert rows_of(gk.cluster(df, dim=2)) == brute(rows, 2, 8, 10)


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="would not fit in a long"):
        gk.cluster(spark.createDataFrame([(1, [1e9, 0.0])], SCHEMA), dim=2).count()


def test_large_components_are_exact():
    r = np.random.default_rng(0)
    x, c = (r.integers(-gk.LIMIT, gk.LIMIT + 1, (50, 64)) for _ in range(2))
    assert gk.squared(x, c[:4]).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in c[:4]] for u in x]
    x, c = x // 64, c // 64
    assert gk.squared(x, c[:4]).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in c[:4]] for u in x]


def test_loosening_bounds_every_vector_of_the_sphere_and_no_more_than_the_drift():
    r, less = np.random.default_rng(2), []
    for trial in range(400):
        dim, k = r.integers(1, 6), 4
        old = r.normal(0, 100, (k, dim))
        new = old + r.normal(0, r.choice([0.01, 5, 300]), (k, dim)) * (r.random((k, 1)) < 0.8)
        radius = r.choice([0, 1, 30, 400], k).astype(float)
        got, drift = gk.loosening(old, new, radius), np.linalg.norm(new - old, axis=1)
        assert (got <= drift * (1 + 1e-12)).all()
        less.append(got / np.maximum(drift, 1e-300))
        for i in range(k):
            x = r.normal(0, 1, (60, dim))
            x = old[i] + x / np.linalg.norm(x, axis=1)[:, None] * radius[i] * r.choice([1, 0.5])
            for j in range(k):
                shrunk = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert (shrunk <= got[i, j] + 1e-9 * (1 + radius[i])).all()
    assert np.mean([(v[~np.eye(4, dtype=bool)] < 0.9).mean() for v in less]) > 0.4


def test_bounds_save_scans_and_geometry_saves_more_than_drift(spark, scratch, monkeypatch):
    rows = cloud(3000, 3, 1, 0.6)
    df = gk.usable(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 3)
    shards = gk.write_shards(df, 3, 1024, scratch("v"), 3 * 4 * 500)
    assert shards.agg({"n": "max"}).first()[0] == 500

    def work():
        done = gk.cluster_shards(shards, gk.starts(df, 8, 3, 1024), 3, 15)
        assert done.work[0] == (3000, 3000)
        return sum(s for _, s in done.work[1:]) / (3000 * len(done.work[1:])), done.centroids.tolist()

    scanned, found = work()
    monkeypatch.setattr(gk, "loosening", lambda old, new, radius: np.tile(np.linalg.norm((new - old).astype(float), axis=1), (len(old), 1)))
    by_drift, same = work()
    assert found == same and scanned < 0.5 and scanned < by_drift
