import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vigil.llm import common
from vigil.llm.digest_index import DigestIndex, deduplicate, digest_rows

SCHEMA = "doc_id long, text string"


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), keep is None or i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in df.collect()), key=str)


@pytest.mark.parametrize("hot", [1, 7, 10_000])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_GROUPS", hot)
    rnd = random.Random(hot)
    rows = [(i, rnd.choice(["same", f"text {rnd.randrange(150)}", f"own {i}", "Same", "same ", "z" * 50_000])) for i in rnd.sample(range(-200, 1000), 400)]
    rows += [(None, "same"), (None, "no id"), (None, "no id"), (5000, None), (5001, ""), rows[3], rows[3], (7, "other text"), (7, "same")]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", F.lit("x").alias("id"), F.lit(1).alias("digest"), F.lit(2).alias("keep_id"))
    assert rows_of(deduplicate(docs)) == brute(rows)
    assert rows_of(deduplicate(docs, arrivals=1)) == brute(rows)


def test_empty_tables(spark):
    assert rows_of(deduplicate(spark.createDataFrame([], SCHEMA))) == []
    assert rows_of(deduplicate(spark.createDataFrame([(None, None)], SCHEMA))) == brute([(None, None)])


def some(spark, *rows):
    return digest_rows(spark.createDataFrame(list(rows), SCHEMA))


def ids_in(index):
    return sorted(r.id for r in index.entries().collect())


def test_the_index_persists_and_first_come_stays(spark, scratch):
    folder = scratch("index")
    DigestIndex.create(spark, folder, 4).add(some(spark, (1, "a"), (2, "b"), (3, "a")), 0)
    index = DigestIndex.open(spark, folder)
    assert index.buckets == 4 and ids_in(index) == [2, 3]
    late = some(spark, (9, "a"), (10, "c"))
    assert [r.id for r in index.unseen(late).collect()] == [10]
    index.add(late, 1)
    assert ids_in(DigestIndex.open(spark, folder)) == [2, 3, 10]
    assert [(r.id, r.keep_id, r.kept) for r in index.verdicts(late).orderBy("id").collect()] == [(9, 3, False), (10, 10, True)]
    with pytest.raises(FileNotFoundError):
        DigestIndex.open(spark, scratch("none"))


def test_a_batch_sent_again_replaces_itself(spark, scratch):
    index = DigestIndex.create(spark, scratch("index"), 3)
    index.add(some(spark, (1, "a")), 0)
    for _ in range(2):
        index.add(some(spark, (2, "b"), (3, "a")), 1)
    assert ids_in(index) == [1, 2]
    index.add(some(spark, (4, "a")), 1)  # nothing new in it: nothing of it stays
    assert ids_in(index) == [1]


def test_what_no_log_row_names_is_not_read(spark, scratch):
    index = DigestIndex.create(spark, scratch("index"), 3)
    index.add(some(spark, (1, "a")), 0)
    some(spark, (2, "b")).select("digest", "id", F.lit("lost").alias("commit")).write.insertInto(index.table)  # the driver ended here
    assert ids_in(index) == [1] and ids_in(DigestIndex.open(spark, index.folder)) == [1]
    index.add(some(spark, (2, "b")), 1)
    assert ids_in(index) == [1, 2]


def test_compaction_keeps_the_entries(spark, scratch):
    index = DigestIndex.create(spark, scratch("index"), 3)
    for b in range(5):
        index.add(some(spark, *[(i, f"t{i % 12}") for i in range(b * 4, b * 4 + 6)]), b)
    before, old = ids_in(index), index.entries()
    index.compact()
    assert ids_in(index) == before == sorted(r.id for r in old.collect()) and len(index.snapshot()[1]) == 1
    index.add(some(spark, (99, "t1"), (100, "new")), 9)
    assert ids_in(DigestIndex.open(spark, index.folder)) == [*before, 100]


def test_the_plan(spark, scratch):
    index = DigestIndex.create(spark, scratch("index"))
    index.add(some(spark, (1, "a")), 0)
    plan = index.unseen(some(spark, (2, "b")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and plan.count("Exchange") == 1  # the new side's only
    assert "Python" not in plan and "InArrow" not in plan
