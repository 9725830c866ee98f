"""How filters of a corpus interact: what each removes, first or after others, in every order.

Sorted posting lists: documents are dealt to ranges of ascending ids of at most ``RANGE_ROWS``
rows, and per range and part (a language, say) one row is written with the failing documents of each
filter, and the good and toxic ones, as sorted lists. Lists hold a row's number within its range, so
repeated and missing ids stay documents of their own. Ranges are audited apart, in tasks that
open one range's lists at a time: the union of each set of filters is merged from a smaller set's union and one
more list, and what a filter removes after a set is the size of a difference. Both gallop: the shorter
list leads, steps through the longer one double until they pass it, and a binary search ends them.
All figures are sizes, so those of the ranges add up (k * 2**(k-1) rows per part for k filters).

Identical texts are found by SHA-256: the least id of each text goes to its rows, broadcast for
groups of more than one in ``HOT_GROUPS`` of all rows and by a sort-merge join for the others.

Defined results: a null text is empty, a null part the empty string; texts without a word have 0 words
and fail none of the shares. A document without an id is identical to no smaller one and has no label;
several label rows of an id count as one that has all their marks. An empty table has no parts and no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize, partitions_for, with_groups

FILTERS, RANGE_ROWS, BLOCK, PARTS_HELD = "ABCDE", 1 << 18, 256, 1000
WORDS_LEAST, DISTINCT_PERCENT, UPPER_PERCENT, MARKS = 100, 80, 10, "[#$%&*|]"
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_LISTS = ("good", "toxic")


# --- which documents fail what -------------------------------------------------------------------

def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id, part, fails, row``: the filters that a document fails, as bits in the order of ``FILTERS``."""
    facts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    facts = facts.withColumn("words", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    upper = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    tests = [n < WORDS_LEAST, distinct * 100 < n * DISTINCT_PERCENT, upper.cast("long") * 100 > F.length("text").cast("long") * UPPER_PERCENT, F.col("text").rlike(MARKS)]
    facts = materialize(facts.select("id", "part", _bits(tests).alias("fails"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")), "facts")
    # where a row is written tells it from any other, the same in every attempt of a task
    rows = facts.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row"))
    least = materialize(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")), "texts")
    copied = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int") * (1 << len(tests))
    return with_groups(rows, least, "digest", "n").select("id", "part", (F.col("fails") + copied).alias("fails"), "row")


def _bits(tests: list[Column]) -> Column:
    total = F.lit(0)
    for i, t in enumerate(tests):
        total = total + F.when(t, 1 << i).otherwise(0)
    return total


def labelled(facts: DataFrame, labels: DataFrame, id_col: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Adds ``good`` and ``toxic``: whether ``labels`` marks the id as 1."""
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(good) == 1, F.lit(False)).alias("good"),
                          F.coalesce(F.col(toxic) == 1, F.lit(False)).alias("toxic")).where("id is not null and (good or toxic)")
    marks = marks.groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    without = facts.where("id is null").select("*", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    joined = facts.where("id is not null").join(marks, "id", "left").na.fill(False, ["good", "toxic"])
    return joined.unionByName(without)


# --- posting lists -------------------------------------------------------------------------------

def _packed(places: np.ndarray) -> bytes:
    return places.astype("<i4").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4")


def _lists(rows: pa.Table, names: str) -> pa.RecordBatch:
    """The lists of one range, a row per part."""
    part = rows.column("part").combine_chunks().dictionary_encode()
    code, fails = part.indices.to_numpy(), rows.column("fails").to_numpy()
    marks = {c: rows.column(c).to_numpy(zero_copy_only=False) for c in _LISTS}
    order = np.argsort(code, kind="stable")
    ids = rows.column("id").drop_null()
    low, high = (ids[0].as_py(), ids[-1].as_py()) if len(ids) else (None, None)
    out: dict[str, list] = {c: [] for c in ("first_id", "last_id", "part", "n", *names, *_LISTS)}
    for here in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):  # places in ascending order
        for c, v in (("first_id", low), ("last_id", high), ("part", part.dictionary[int(code[here[0]])].as_py()), ("n", len(here))):
            out[c].append(v)
        for i, name in enumerate(names):
            out[name].append(_packed(here[fails[here] >> i & 1 == 1]))
        for c in _LISTS:
            out[c].append(_packed(here[marks[c][here]]))
    kinds = {"first_id": pa.int64(), "last_id": pa.int64(), "part": pa.string(), "n": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()], list(out))


def postings(facts: DataFrame, names: str = FILTERS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``first_id, last_id, part, n``, a list per filter, ``good, toxic``: one written row per id range and part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            while b.num_rows:
                take = b.slice(0, range_rows - size)
                held.append(take)
                size, b = size + take.num_rows, b.slice(take.num_rows)
                if size == range_rows:
                    yield _lists(pa.Table.from_batches(held), names)
                    held, size = [], 0
        if held:
            yield _lists(pa.Table.from_batches(held), names)

    dealt = facts.repartitionByRange(partitions_for(facts), "id", "row").sortWithinPartitions("id", "row")
    schema = "first_id long, last_id long, part string, n long, " + ", ".join(f"{c} binary" for c in (*names, *_LISTS))
    return materialize(dealt.select("id", "part", "fails", "good", "toxic").mapInArrow(run, schema), "postings")


def found(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Which of ``small`` are in ``large`` (both sorted, without repeats), galloping through ``large``."""
    out, at, end = np.zeros(len(small), bool), 0, len(large)
    for a in range(0, len(small), BLOCK):
        block = small[a:a + BLOCK]
        step = BLOCK
        while at + step < end and large[at + step] < block[-1]:
            at, step = (at + step, step * 2) if large[at + step] < block[0] else (at, step * 2)
        window = large[at:at + step + 1]
        place = np.searchsorted(window, block)
        inside = place < len(window)
        out[a:a + BLOCK][inside] = window[place[inside]] == block[inside]
        at += int(place[-1])
        if at >= end:
            break
    return out


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many places two lists share; the shorter one leads."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return int(found(small, large).sum())


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The union of two lists: what the longer one lacks is put in its places."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    new = small[~found(small, large)]
    if not len(new):
        return large
    out = np.empty(len(large) + len(new), large.dtype)
    into = np.searchsorted(large, new) + np.arange(len(new))
    rest = np.ones(len(out), bool)
    rest[into] = False
    out[into], out[rest] = new, large
    return out


def figures(n: int, lists: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """``FIGURES`` of each set ``s`` of filters applied before and filter ``f`` next: ``[s, f]``, 0 where f is in s."""
    k = len(lists)
    every = (1 << k) - 1
    unions = [np.empty(0, np.int32)]
    for s in range(1, every + 1):
        top = s.bit_length() - 1
        unions.append(merged(unions[s ^ 1 << top], lists[top]))
    marked = [[x[found(x, m)] if len(x) <= len(m) else m[found(m, x)] for x in lists] for m in (good, toxic)]
    out = np.zeros((every + 1, k, len(FIGURES)), np.int64)
    for s in range(every + 1):
        for f in (f for f in range(k) if not s >> f & 1):
            removed = len(lists[f]) - shared(lists[f], unions[s])
            lost = [len(x[f]) - shared(x[f], unions[s]) for x in marked]
            out[s, f, :3] = n - len(unions[s]) - removed, removed, len(lists[f]) - removed
            out[s, f, 4:6] = lost
    for f in range(k):
        out[:, f, 3] = out[every ^ 1 << f, f, 1]
        out[:, f, 6] = sum(factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) * out[s, f, 1] for s in range(every + 1) if not s >> f & 1)
    return out


# --- all orders ----------------------------------------------------------------------------------

def interactions(lists: DataFrame, names: str = FILTERS) -> DataFrame:
    """``part, before, next`` and ``FIGURES``: for each set of filters applied before and each filter after it."""
    k = len(names)
    pairs = [(s, f) for s in range(1 << k) for f in range(k) if not s >> f & 1]
    at = tuple(np.array(x) for x in zip(*pairs))

    def batch(totals: dict[str, np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate([t[at] for t in totals.values()])
        keys = [pa.array(np.repeat(list(totals), len(pairs)).tolist(), pa.string()), pa.array(np.tile(at[0], len(totals)), pa.int32()), pa.array(np.tile(at[1], len(totals)), pa.int32())]
        return pa.RecordBatch.from_arrays(keys + [pa.array(c, pa.int64()) for c in rows.T], ["part", "before", "next", *FIGURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                got = figures(row["n"], [_unpacked(row[c]) for c in names], _unpacked(row["good"]), _unpacked(row["toxic"]))
                totals[row["part"]] = totals.get(row["part"], 0) + got
                if len(totals) >= PARTS_HELD:
                    yield batch(totals)
                    totals = {}
        if totals:
            yield batch(totals)

    schema = "part string, before int, next int, " + ", ".join(f"{c} long" for c in FIGURES)
    sums = lists.select("part", "n", *names, *_LISTS).mapInArrow(run, schema)
    return sums.groupBy("part", "before", "next").agg(*[F.sum(c).alias(c) for c in FIGURES])


def in_all_orders(found_: DataFrame, names: str = FILTERS) -> DataFrame:
    """``part, filter_order, step`` and ``FIGURES`` of each order of the filters and each step of it."""
    steps = [("".join(o), i + 1, sum(1 << names.index(c) for c in o[:i]), names.index(c)) for o in permutations(names) for i, c in enumerate(o)]
    table = found_.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, next int")  # as many rows as k filters have, k * k!
    return found_.join(F.broadcast(table), ["before", "next"]).select("part", "filter_order", "step", *FIGURES)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The five text filters over ``docs``: ``part, filter_order, step`` and ``FIGURES``."""
    facts = labelled(failures(docs, id_col, text_col, part_col), labels)
    return in_all_orders(interactions(postings(facts)))
