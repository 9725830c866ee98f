import threading

import pytest
from pyspark.sql import functions as F

from vigil import storage
from vigil.sinks.keyed_table import KeyedTable

SCHEMA = "id string, split string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(f"k{i}", "train" if i % 2 else "val", n) for i, n in rows], SCHEMA)


@pytest.fixture()
def table(spark, scratch):
    return KeyedTable.create(spark, scratch("keyed"), "id", frame(spark, []).schema, buckets=4, by=("split",))


def view(df):
    return {r.id: r.n for r in df.collect()}


def test_last_write_wins_and_replays_leave_nothing(spark, table):
    table.upsert(frame(spark, [(i, 0) for i in range(20)]), 0, 0)
    table.upsert(frame(spark, [(i, 1) for i in range(5, 25)]), 0, 1)
    assert view(table.current()) == {f"k{i}": int(i >= 5) for i in range(25)}
    table.upsert(frame(spark, [(6, 2)]), 0, 1)  # sent again with fewer rows
    assert view(table.current()) == {f"k{i}": 2 if i == 6 else 0 for i in range(20)}
    table.upsert(frame(spark, []), 0, 1)  # and with none
    assert view(table.current()) == {f"k{i}": 0 for i in range(20)}
    table.upsert(frame(spark, [(3, 9)]), 1, 0)  # a later run wins over any batch of an earlier one
    table.upsert(frame(spark, [(3, 5)]), 0, 7)
    assert view(table.current())["k3"] == 9
    assert view(table.current(version=1)) == {f"k{i}": 0 for i in range(20)}


def test_another_session_state_sees_the_commits(spark, table):
    table.upsert(frame(spark, [(1, 1), (2, 1)]), 0, 0)
    spark.sql(f"DROP TABLE {table.name}")
    again = KeyedTable.open(spark, table.path)
    assert view(again.current()) == {"k1": 1, "k2": 1} and again.by == ("split",) and again.buckets == 4
    with pytest.raises(FileExistsError):
        KeyedTable.create(spark, table.path, "id", table.schema)
    with pytest.raises(FileNotFoundError):
        KeyedTable.open(spark, table.path + "-none")


def test_uncommitted_files_are_not_read(spark, table):
    table.upsert(frame(spark, [(1, 1)]), 0, 0)
    table._write(frame(spark, [(1, 5), (2, 5)]).withColumn("run_id", F.lit(0)).withColumn("batch_id", F.lit(1)))  # the driver ended before the log
    assert view(table.current()) == {"k1": 1}
    assert len(table.vacuum(keep=1)) == 1 and view(table.current()) == {"k1": 1}


def test_an_unfinished_log_file_is_passed_over(spark, table, monkeypatch):
    from vigil.sinks import keyed_table

    monkeypatch.setattr(keyed_table, "WAITS", 2)
    table.upsert(frame(spark, [(1, 1)]), 0, 0)
    storage.create_exclusive(spark, f"{table.path}/_log/{2:012d}.json", '{"version": 2, "comm')
    assert view(table.current()) == {"k1": 1}
    assert table.upsert(frame(spark, [(2, 1)]), 0, 1) == 3
    assert view(table.current()) == {"k1": 1, "k2": 1}


def test_writers_at_the_same_time_lose_nothing(spark, table):
    errors = []

    def write(run):
        try:
            KeyedTable.open(spark, table.path).upsert(frame(spark, [(run, run)]), run, 0)
        except Exception as e:  # shown below
            errors.append(e)

    threads = [threading.Thread(target=write, args=(r,)) for r in range(4)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert not errors and view(table.current()) == {f"k{r}": r for r in range(4)} and len(table.versions()) == 4


def test_compaction_beside_readers(spark, table):
    for b in range(4):
        table.upsert(frame(spark, [(i, b) for i in range(b, 12)]), 0, b)
    before, old = view(table.current()), table.current()
    version = table.compact()
    live = table.snapshot()[1]
    assert [(c.run_id, c.batch_id) for c in live] == [(-1, 0), (0, 3)] and version == 5
    assert view(table.current()) == before == view(old) == view(table.current(version=4))
    table.upsert(frame(spark, [(0, 7)]), 0, 3)  # the stream sends its last batch again
    assert view(table.current()) == {**{f"k{i}": min(i, 2) for i in range(12)}, "k0": 7}
    with pytest.raises(ValueError, match="compacted"):
        table.upsert(frame(spark, [(0, 8)]), 0, 1)
    table.upsert(frame(spark, [(1, 9)]), 0, 4)
    table.compact()
    assert view(table.current())["k1"] == 9 and view(table.current())["k0"] == 7
    with pytest.raises(ValueError, match="compacted"):
        table.upsert(frame(spark, [(0, 8)]), 0, 1)
    assert table.vacuum(keep=1) and view(table.current())["k0"] == 7


def test_point_reads_open_only_files_that_may_hold_the_key(spark, scratch):
    table = KeyedTable.create(spark, scratch("keyed"), "id", spark.createDataFrame([], "id long, v string").schema, buckets=4)
    for b in range(5):
        table.upsert(spark.range(b * 1000, b * 1000 + 1000).select((F.col("id") * 3).alias("id"), F.concat(F.lit(f"b{b}-"), "id").alias("v")), 0, b)
    table.upsert(spark.createDataFrame([(30, "new")], "id long, v string"), 0, 9)
    keys = spark.createDataFrame([(30,), (7 * 3,), (9000 * 3,), (31,)], "id long")
    files = table.files_for(keys)
    got = table.lookup(keys)
    assert {r.id: r.v for r in got.collect()} == {30: "new", 21: "b0-7"}
    names = sorted(f.rsplit("/", 1)[1] for f in files)
    assert sorted(f.rsplit("/", 1)[1] for f in got.inputFiles()) == names and 2 <= len(files) <= 4  # of 21
    absent = spark.range(0, 600).select((F.col("id") * 3 + 1).alias("id"))  # inside the range of the first batch, in no file
    none = [k for k in range(20) if table.files_for(absent.where(F.col("id") == k * 3 + 1))]
    assert len(none) <= 3
    assert table.lookup(keys.where("id = 31")).count() == 0
    assert table.lookup(spark.createDataFrame([(9000 * 3,)], "id long")).count() == 0


def test_null_keys_and_empty_table(spark, table):
    assert table.current().count() == 0 and table.lookup(frame(spark, [(1, 1)])).count() == 0 and table.compact() == 0
    table.upsert(spark.createDataFrame([(None, "val", 3), ("a", None, 4)], SCHEMA), 0, 0)
    assert {(r.id, r.split, r.n) for r in table.current().collect()} == {(None, "val", 3), ("a", None, 4)}


def test_the_merge_needs_no_exchange_and_the_split_prunes(spark, table):
    for b in range(2):
        table.upsert(frame(spark, [(i, b) for i in range(20)]), 0, b)
    df = table.current(F.col("split") == "val")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "split" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert df.count() == 10
