"""Structured Streaming jobs (OP-60, OP-61, OP-62, OP-64, OP-65, OP-66, OP-18, OP-40).

Every job reuses the batch functions unchanged inside ``foreachBatch``:

* the micro-batch is persisted once (counted once, checked for emptiness once) instead
  of being re-read for every action;
* a batch owns its commit in the keyed table, or its ``(run_id, batch_id)`` folder, so a batch
  replayed after a failure replaces itself as a whole (exactly-once result), and a new checkpoint
  gets a new ``run_id`` (kept in a file next to the checkpoint) so restarted batch ids
  never overwrite earlier runs;
* write errors fail the batch (the query stops and restarts from its checkpoint)
  instead of being swallowed;
* a checkpoint location is mandatory for every sink.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.upsert import dedupe_in_batch
from vigil.sinks.keyed_table import KeyedTable
from vigil.sinks.store import write_batch
from vigil.sources.envelope import decode, split_quarantine

Featurizer = Callable[[DataFrame], DataFrame]


# --- small file-system helpers (Hadoop FS: works on any shared storage) ---------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def file_state(spark: SparkSession, path: str) -> str:
    """Length and modification time of a file."""
    fs, p = _fs(spark, path)
    state = fs.getFileStatus(p)
    return f"{state.getLen()}:{state.getModificationTime()}"


def list_run_ids(spark: SparkSession, table: str) -> list[int]:
    fs, p = _fs(spark, table)
    if not fs.exists(p):
        return []
    ids = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("run_id="):
            ids.append(int(name.split("=", 1)[1]))
    return ids


def run_id_for(spark: SparkSession, checkpoint: str, table: str) -> int:
    """Stable per checkpoint: reuse the stored id on restart, else reserve a fresh one.

    The reservation is a file that only one caller can create, so two checkpoints that
    start together never share an id."""
    marker = checkpoint.rstrip("/") + ".run_id"
    stored = read_text(spark, marker)
    if stored is not None:
        return int(stored)
    rid = max(list_run_ids(spark, table), default=-1) + 1
    while not _reserve(spark, f"{table.rstrip('/')}.run_ids/{rid}"):
        rid += 1
    write_text(spark, marker, str(rid))
    return rid


def _reserve(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        return bool(fs.createNewFile(p))
    except Exception as e:  # some file systems raise instead of returning false
        if fs.exists(p):
            return False
        raise e


# --- records of a micro-batch ----------------------------------------------------------

POSITION = ("timestamp", "source_file", "topic", "partition", "offset")  # those that the source has


def decoded_batch(batch: DataFrame, mode: str) -> DataFrame:
    """Decoded envelopes with the raw record and its place in the stream (``position``)."""
    place = [F.col(c) for c in POSITION if c in batch.columns]
    tagged = batch.withColumn("position", F.struct(*place, F.monotonically_increasing_id().alias("row")))
    raw = [c for c in ("key", "value") if c in batch.columns]
    return decode(tagged, mode, keep=[*raw, "position"])


def last_of_each(good: DataFrame, key: str) -> DataFrame:
    """Of several records of a key in one micro-batch the last one by position."""
    return dedupe_in_batch(good, key, "position").drop("position", *[c for c in ("value",) if c != key])


def quarantine_of(table: str) -> str:
    return table.rstrip("/") + "_quarantine"


# --- jobs ---------------------------------------------------------------------------

@dataclass
class StreamResult:
    query_id: str
    batches: int
    run_id: int


def run_stream(writer, trigger_once: bool, processing_time: str | None = None):
    """``availableNow`` (process what is there, then stop) or a continuous query with an
    optional processing-time trigger (e.g. "5 seconds", the original's polling pace)."""
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    q = writer.start()
    if trigger_once:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return q


def ingest_to_store(records: DataFrame, store: str, checkpoint: str, featurize: Featurizer,
                    mode: str = "training", key: str = "id",
                    quarantine: str | None = None, available_now: bool = True, by: tuple[str, ...] = (),
                    buckets: int | None = None) -> StreamResult:
    """Stream -> decode -> featurize -> keyed table (OP-60), one commit a batch, also partitioned by
    the columns ``by``, whose values a key never changes (e.g. its split).

    Records without a key go, with their raw bytes and position, to ``quarantine``
    (default: next to the store)."""
    spark = records.sparkSession
    quarantine = quarantine or quarantine_of(store)
    run_id = run_id_for(spark, checkpoint, store)
    seen = {"batches": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        # decode once and keep the decoded batch: the emptiness check, the quarantine,
        # the featurizer's lookups and the write all reuse it
        decoded = decoded_batch(batch, mode).persist()
        try:
            if decoded.isEmpty():  # e.g. a trailing empty trigger
                return
            good, bad = split_quarantine(decoded)
            write_batch(bad, quarantine, run_id, batch_id)
            rows = featurize(last_of_each(good, key))
            KeyedTable.open_or_create(rows.sparkSession, store, key, rows.schema, by=by, buckets=buckets).upsert(rows, run_id, batch_id)
            seen["batches"] += 1
        finally:
            decoded.unpersist()

    q = run_stream(records.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint),
             available_now)
    return StreamResult(q.id, seen["batches"], run_id)


def land(records: DataFrame, landing: str, checkpoint: str, featurize: Featurizer,
         mode: str = "inference", quarantine: str | None = None, available_now: bool = True) -> StreamResult:
    """Stream -> decode -> featurize (payload or path strategy) -> per-batch overwrite (OP-61);
    records without a key go to ``quarantine`` (default: next to the landing table)."""
    spark = records.sparkSession
    quarantine = quarantine or quarantine_of(landing)
    run_id = run_id_for(spark, checkpoint, landing)
    seen = {"batches": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        decoded = decoded_batch(batch, mode).persist()  # parsed once per micro-batch
        try:
            if decoded.isEmpty():
                return
            good, bad = split_quarantine(decoded)
            write_batch(bad, quarantine, run_id, batch_id)
            write_batch(featurize(good.drop("value", "position")), landing, run_id, batch_id)
            seen["batches"] += 1
        finally:
            decoded.unpersist()

    q = run_stream(records.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint),
             available_now)
    return StreamResult(q.id, seen["batches"], run_id)


def dedupe(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Replay-safe dedupe by key within the watermark delay (OP-66); state is bounded
    by the delay. ``event_time`` must be a TIMESTAMP (cast NTZ columns first)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def append_parquet(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Exactly-once file sink (the sink's own log plus the checkpoint)."""
    return run_stream(stream.writeStream.format("parquet").option("path", path)
                .option("checkpointLocation", checkpoint).outputMode("append"), available_now)


def batch_stats(records: DataFrame, table: str, checkpoint: str, group: str,
                available_now: bool = True) -> StreamResult:
    """Record per micro-batch row counts by ``group`` (OP-40, OP-64 pacing check)."""
    spark = records.sparkSession
    run_id = run_id_for(spark, checkpoint, table)
    seen = {"batches": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        stats = batch.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"))
        write_batch(stats, table, run_id, batch_id)
        seen["batches"] += 1

    q = run_stream(records.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint),
             available_now)
    return StreamResult(q.id, seen["batches"], run_id)


def score_landed(landed: DataFrame, predictions: str, checkpoint: str,
                 score: Callable[[DataFrame], DataFrame], available_now: bool = True,
                 processing_time: str | None = None) -> StreamResult:
    """Incremental scoring of newly landed rows (OP-65): the file source's checkpoint
    is the 'seen batches' log; results are appended per micro-batch."""
    spark = landed.sparkSession
    run_id = run_id_for(spark, checkpoint, predictions)
    seen = {"batches": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            write_batch(score(batch), predictions, run_id, batch_id)
            seen["batches"] += 1
        finally:
            batch.unpersist()

    q = run_stream(landed.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint),
             available_now, processing_time)
    return StreamResult(q.id, seen["batches"], run_id)
