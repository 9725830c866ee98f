import os
import random

from pyspark.sql import functions as F

from vigil.sources.payloads import look_up, with_payloads


def test_all_statuses_ranges_and_repeats(spark, scratch):
    root = scratch("media").replace("file:", "")
    os.makedirs(f"{root}/a folder")
    rng = random.Random(3)
    bodies = {f"f{n}": rng.randbytes(n) for n in (1, 99, 100, 101, 1000, 12_345)}
    for name, body in bodies.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(body)
    open(f"{root}/empty é", "wb").close()
    with open("/tmp/outside-of-root", "wb") as f:
        f.write(b"x")
    urls = [f"{root}/{n}" for n in bodies] + [f"file:{root}/f99", f"file://{root}/f1000"] + [f"{root}/f12345"] * 40
    urls += [f"{root}/empty é", f"{root}/none", f"{root}/a folder", None, "nosuch://x/y", "/tmp/outside-of-root", f"{root}/../x"]
    wanted = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "i int, url string, path string")
    got = with_payloads(spark, wanted, under=root, range_bytes=100, task_bytes=1 << 20).collect()
    assert len(got) == len(urls) and all(r.path == "mine" for r in got)
    for r in got:
        name = (r.url or "").rsplit("/", 1)[-1]
        if name in bodies:
            assert (r.payload_status, bytes(r.content)) == ("ok", bodies[name])
        else:
            want = {"empty é": "empty", "a folder": "unreadable"}.get(name, "missing")
            assert (r.payload_status, r.content) == (want, None)
    free = with_payloads(spark, wanted.where(F.col("url").startswith("nosuch"))).collect()
    assert [r.payload_status for r in free] == ["unreadable"] and free[0].payload_error
    assert look_up(wanted, "url").where("status = 'ok'").count() == len(bodies) + 2 + 1  # each spelling once, and the one outside
    assert with_payloads(spark, wanted.limit(0)).count() == 0


def test_small_files_dont_make_tasks_without_end():
    from vigil.sources.payloads import SLOT_TASKS, TASK_BYTES, tasks_for

    assert tasks_for(0, 0, 12) == 1 and tasks_for(10, 1, 12) == 1
    assert tasks_for(10_000 * 500, 500, 12) == 4  # few files: by what opening them costs
    assert tasks_for(10_000 * 4_000_000, 4_000_000, 12) == max(SLOT_TASKS * 12, -(-10_000 * 4_000_000 // TASK_BYTES))
    assert tasks_for(1000 * TASK_BYTES, 200_000, 12) == 1000  # bytes of a task stay bounded
