"""Payload load by path, in ranges (OP-07).

Only the wanted paths are opened; no folder is ever listed. Two steps, each recovered by Spark like any other task:

1. every distinct path is looked up once: its length, or why there is none (``missing``, ``empty``, ``unreadable``);
2. files are cut into ranges of at most ``range_bytes``, and the ranges are dealt to tasks of about ``task_bytes``: a
   file of any length is read by many tasks, a task reads a bounded number of bytes, whatever the mix of lengths. Small
   files make more tasks, up to ``SLOT_TASKS`` per slot: what tasks report to the driver doesn't grow with their number.

Files of one range, the usual case, are never shuffled after they were read; those of several are put together by path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import materialize

RANGE_BYTES = 8 << 20
TASK_BYTES = 128 << 20
OPEN_COST = 1 << 20  # what opening a file counts as, in bytes
SLOT_TASKS = 16
BATCH_BYTES = 8 << 20  # of read ranges sent to Spark at once

_STAT = pa.schema([("path", pa.string()), ("length", pa.int64()), ("status", pa.string()), ("error", pa.string())])
_READ = pa.schema([("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("bytes", pa.binary()), ("error", pa.string())])


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    plain = path[5:] if path.startswith("file:/") else path
    if plain.startswith("/"):
        return fs.LocalFileSystem(), "/" + plain.lstrip("/")
    return fs.FileSystem.from_uri(path)


def _stat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path in batch.column("path").to_pylist():
            try:
                system, name = _opened(path)
                info = system.get_file_info(name)
                if info.type == fs.FileType.NotFound:
                    rows.append((path, None, "missing", None))
                elif info.type != fs.FileType.File:
                    rows.append((path, None, "unreadable", "not a file"))
                else:
                    rows.append((path, info.size, "empty" if info.size == 0 else "ok", None))
            except Exception as e:  # a path's failure is that path's status
                rows.append((path, None, "unreadable", str(e)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, _STAT)], schema=_STAT)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _READ)], schema=_READ)
    for batch in batches:
        for r in batch.to_pylist():
            data, error = None, None
            try:
                system, name = _opened(r["path"])
                with system.open_input_file(name) as f:
                    data = f.read_at(min(r["take"], r["length"] - r["start"]), r["start"])
                if len(data) != min(r["take"], r["length"] - r["start"]):
                    data, error = None, "changed while it was read"
            except Exception as e:
                error = str(e)
            held.append((r["path"], r["start"], r["length"], data, error))
            size += len(data or b"")
            if size >= BATCH_BYTES:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def look_up(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """``path, length, status, error`` of each distinct path; null paths have none."""
    spark = paths.sparkSession
    once = paths.select(F.col(path_col).alias("path")).where("path IS NOT NULL").distinct()
    # a look-up waits for storage: many tasks, however few bytes the paths are
    return materialize(once.repartition(4 * spark.sparkContext.defaultParallelism, "path").mapInArrow(_stat, "path string, length long, status string, error string"), "paths")


def tasks_for(length: int, ranges: int, slots: int, task_bytes: int = TASK_BYTES) -> int:
    """Tasks that read ``length`` bytes in ``ranges`` ranges."""
    by_bytes, by_cost = (-(-n // task_bytes) for n in (length, length + ranges * OPEN_COST))
    return max(1, by_bytes, min(by_cost, SLOT_TASKS * slots))


def fetch(found: DataFrame, range_bytes: int = RANGE_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``path, content, payload_status, payload_error`` of every row of ``look_up``; the content is null unless ``ok``."""
    ok = found.where("status = 'ok'")
    length, n = ok.agg(F.sum("length"), F.sum(F.ceil(F.col("length") / range_bytes))).first()
    tasks = tasks_for(length or 0, n or 0, found.sparkSession.sparkContext.defaultParallelism, task_bytes)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = ok.select("path", "length", starts.alias("start"), F.lit(range_bytes).cast("long").alias("take"))
    ranges = ranges.repartition(tasks, "path", "start")
    read = ranges.mapInArrow(_read, "path string, start long, length long, bytes binary, error string")
    status = F.when(F.col("payload_error").isNotNull(), "unreadable").otherwise("ok")
    short = read.where(F.col("length") <= range_bytes).select("path", F.col("bytes").alias("content"), F.col("error").alias("payload_error"))
    pieces = F.array_sort(F.collect_list(F.struct("start", "bytes")))
    long = read.where(F.col("length") > range_bytes).groupBy("path").agg(pieces.alias("pieces"), F.max("error").alias("payload_error"))
    joined = F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["bytes"])), ""))
    long = long.select("path", F.when(F.col("payload_error").isNull(), joined).alias("content"), "payload_error")
    rest = found.where("status <> 'ok'").select("path", F.lit(None).cast("binary").alias("content"), F.col("status").alias("payload_status"), F.col("error").alias("payload_error"))
    return short.unionByName(long).withColumn("payload_status", status).unionByName(rest)


def with_payloads(spark: SparkSession, wanted: DataFrame, url_col: str = "url", under: str | None = None, **sizes: int) -> DataFrame:
    """``wanted`` with ``content``, ``payload_status`` (ok, empty, missing, unreadable) and ``payload_error``. A null path is
    missing, and so is, if ``under`` is given, one outside of that folder. A path that many rows want is read once."""
    url = F.col(url_col)
    if under is not None:
        plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
        inside = F.startswith(plain(url), plain(F.lit(under.rstrip("/") + "/"))) & ~F.contains(url, F.lit("/../"))
        url = F.when(inside, url)
    asked = wanted.withColumn("__path", url)
    files = fetch(look_up(asked, "__path"), **sizes).withColumnRenamed("path", "__path")
    # contents are larger than any estimate of them: never collected for a broadcast
    out = asked.join(files.hint("merge"), "__path", "left").drop("__path")
    return out.withColumn("payload_status", F.coalesce("payload_status", F.lit("missing")))
