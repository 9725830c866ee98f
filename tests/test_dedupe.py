from datetime import datetime, timedelta

import pytest

from vigil.streaming.dedupe import Accounts, dedupe_accounted

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp, v int"


def send(spark, src, batches):
    for i, rows in enumerate(batches):
        data = [(k, None if m is None else T0 + timedelta(minutes=m), v) for k, m, v in rows]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{src}/b={i:03d}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")


def brute(batches, delay):
    """Outcome counts and the kept values."""
    kept, late, dup, memory, top = [], [], 0, {}, None
    for rows in batches:
        mark = None if top is None else top - delay
        on_time = [r for r in rows if r[1] is not None and (mark is None or r[1] >= mark)]
        late += [r for r in rows if r not in on_time]
        memory = {k: m for k, m in memory.items() if mark is None or m + delay > mark}
        for k in {r[0] for r in on_time}:
            some = sorted((r for r in on_time if r[0] == k), key=lambda r: r[1])
            if k in memory:
                dup += len(some)
            else:
                kept.append(some[0])
                dup += len(some) - 1
                memory[k] = some[0][1]
        top = max([m for _, m, _ in rows if m is not None] + ([] if top is None else [top]), default=None)
    return sorted(kept, key=str), sorted(late, key=str), dup


def found(spark, folder):
    minutes = lambda r: None if r.ts is None else int((r.ts - T0).total_seconds() // 60)
    a = Accounts(folder)
    rows = [sorted(((r.k, minutes(r), r.v) for r in a.read(spark, n).collect()), key=str) for n in ("kept", "late")]
    return (*rows, sum(r.n for r in a.read(spark, "duplicates").collect()))


BATCHES = [
    [("a", 0, 1), ("a", 1, 2), ("b", 5, 3), (None, 3, 4), (None, 4, 5), ("n", None, 6)],
    [("a", 6, 7), ("c", 30, 8)],
    [("d", 19, 9), ("d", 20, 10), ("a", 21, 11), ("c", 31, 12), ("e", 60, 13)],  # mark: 20
    [("c", 50, 14), ("c", 51, 15), ("f", 49, 16), ("e", 55, 17)],  # mark: 50; c is forgotten at 40
    [],
    [("g", 200, 18), ("e", 52, 19)],
    [("g", 201, 20), ("e", 195, 21), (None, 190, 22)],
]


def test_against_brute_force(spark, scratch):
    src, out = scratch("src"), scratch("out")
    stream = send(spark, src, BATCHES)
    dedupe_accounted(stream, "k", "ts", 600, out, scratch("ck"))
    got = found(spark, out)
    assert got == brute(BATCHES, 10)
    assert len(got[0]) + len(got[1]) + got[2] == sum(map(len, BATCHES))


def test_a_batch_that_fails_half_way_is_done_again(spark, scratch, monkeypatch):
    from vigil.streaming import dedupe

    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    stream, plain, calls = send(spark, src, BATCHES), dedupe.write_batch, []

    def flaky(df, path, run, batch):
        calls.append(path)
        if len(calls) == 11:  # within the third batch, after part of it was written
            raise RuntimeError("lost")
        plain(df, path, run, batch)

    monkeypatch.setattr(dedupe, "write_batch", flaky)
    with pytest.raises(Exception):
        dedupe_accounted(stream, "k", "ts", 600, out, ck)
    dedupe_accounted(stream, "k", "ts", 600, out, ck)
    assert found(spark, out) == brute(BATCHES, 10)
