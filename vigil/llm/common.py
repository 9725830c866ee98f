"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators import joins
from vigil.session import materialize

BATCH_BYTES = 1 << 20  # texts are worked on in groups of about this size; temporaries take about 40 times that


def small_batches(df: DataFrame, rows: int = 500, size: str = "2m") -> DataFrame:
    """Bounds the batches that the session hands to Python tasks: whole texts are long.

    The limits are the session's and stay set, since a plan takes those that hold when it runs,
    which may be long after it was built (README, "Arrow batches").
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def unused_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have (names are compared without case)."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


FILTER_BITS = joins.FILTER_BITS


def with_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``joins.with_ids`` by a bitmap of this module's ``FILTER_BITS``."""
    return joins.with_ids(rows, ids, FILTER_BITS)


def text_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id long, text binary`` (UTF-8; a null text is empty); extra columns are not read."""
    return small_batches(df).select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def groups_by_bytes(ids: list, texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Slices of a batch of about ``limit`` bytes; a longer text is a slice of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield ids[start:i], texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield ids[start:], texts[start:]


def partitions_for(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``key`` out of batches sorted by it.

    Only the last run of a batch is carried over; keys must be given to bounded groups.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(k[1:] != k[:-1]) + 1
        if held and held[-1].column(key)[-1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        if not len(cuts):
            held.append(b)
            continue
        yield pa.Table.from_batches([*held, b.slice(0, int(cuts[0]))])
        if len(cuts) > 1:
            yield pa.Table.from_batches([b.slice(int(cuts[0]), int(cuts[-1] - cuts[0]))])
        held = [b.slice(int(cuts[-1]))]
    if held:
        yield pa.Table.from_batches(held)


def fixed_bytes(column: pa.Array | pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    """A binary column of equal lengths as a matrix of ``width`` values a row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.empty((0, width), dtype)
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]]
    return data.view(dtype).reshape(-1, width)


HOT_GROUPS = 10_000


def with_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Each row with the columns of its group: ``groups`` (a written table) has one row per ``key`` and its ``size`` in rows.

    Of groups above one in ``HOT_GROUPS`` of all rows there are fewer than ``HOT_GROUPS``: those are
    broadcast and their rows stay where they are. The others' rows meet by a sort-merge join, none of
    whose keys has more than that share.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_GROUPS > total
    columns = [*rows.columns, *(c for c in groups.columns if c != key)]
    tops = F.broadcast(groups.where(hot))
    rest = rows.join(tops.select(key), key, "left_anti").join(groups.where(~hot).hint("merge"), key)
    return rows.join(tops, key).select(columns).unionByName(rest.select(columns))


def sorted_map(df: DataFrame, key: str, fn: Callable, schema: str) -> DataFrame:
    """``fn`` over each partition's batches, dealt and sorted by ``key``."""
    return df.repartition(partitions_for(df), key).sortWithinPartitions(key).mapInArrow(fn, schema)


__all__ = ["fixed_bytes", "groups_by_bytes", "materialize", "partitions_for", "runs",
           "small_batches", "sorted_map", "text_rows", "unused_name", "with_groups", "with_ids"]
