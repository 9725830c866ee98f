import os
import subprocess
import sys
import time

import numpy as np

from vigil.operators.contained import contained
from vigil.operators.featurize import Extractor, featurize


def codec() -> Extractor:
    def init():
        def extract(text):
            if text == "kill":
                os.kill(os.getpid(), 9)
            if text == "exit":
                os._exit(3)
            if text == "hang":
                time.sleep(3600)
            if text == "fail":
                raise ValueError("spoiled")
            if text == "much":
                np.ones(1 << 30).sum()
            return [len(text), os.getpid() % 1000]
        return extract
    return Extractor("codec", 2, init)


def test_every_row_has_features_or_a_reason(spark):
    words = ["one", "kill", "three", "hang", "fail", "exit", "much", "", "four", "kill", "kill", "five"]
    rows = [(i, w) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    got = featurize(df, "id", "text", [contained(codec(), seconds=1, memory_mb=1024)]).orderBy("id").collect()
    why = {"kill": "killed by signal 9", "hang": "no answer in 1 s", "fail": "spoiled", "exit": "ended with code 3"}
    for r, w in zip(got, words):
        if w == "much":
            assert r.status == "fallback" and r.codec == [0.0, 0.0]
        elif w in why:
            assert (r.status, r.error, r.codec) == ("fallback", f"codec: {why[w]}", [0.0, 0.0])
        else:
            assert (r.status, r.error, r.codec[0]) == ("ok", None, len(w))


def test_a_failing_init_is_a_reason_and_wide_values_pass(spark):
    def broken():
        raise RuntimeError("no weights")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    got = featurize(df, "id", "text", [contained(Extractor("x", 1, broken))]).collect()
    assert {r.error for r in got} == {"x: init: no weights"}
    wide = contained(Extractor("w", 50_000, lambda: lambda t: np.full(50_000, len(t)))).init()
    assert wide("y" * 3_000_000).sum() == 50_000 * 3_000_000
    wide.close()


def test_the_child_ends_with_its_task():
    code = ("import os, sys, time; sys.path.insert(0, '.'); from vigil.operators.contained import contained; "
            "from vigil.operators.featurize import Extractor; c = contained(Extractor('x', 1, lambda: lambda t: [0])).init(); "
            "c('a'); print(c.process.pid, flush=True); os.kill(os.getpid(), 9)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=60, cwd=os.path.dirname(os.path.dirname(__file__)))
    pid = int(out.stdout)
    for _ in range(50):
        try:
            with open(f"/proc/{pid}/stat") as f:
                if f.read().split()[2] == "Z":
                    return
        except FileNotFoundError:
            return
        time.sleep(0.1)
    raise AssertionError("the child is still there")


def test_values_that_hang_are_waited_for_together():
    import time

    def init():
        def extract(v):
            if v % 10 == 9:
                time.sleep(60)
            if v == 5:
                raise ValueError("no")
            return [v]
        return extract
    extract = contained(Extractor("x", 1, init), seconds=1).init()
    try:
        begun = time.monotonic()
        got = list(extract.stream(iter(range(60))))
    finally:
        extract.close()
    assert [a if good else str(a) for good, a in got] == ["no answer in 1 s" if v % 10 == 9 else "no" if v == 5 else [v] for v in range(60)]
    assert time.monotonic() - begun < 4  # six of them, one after the other: more than 6 s
