"""Stream dedupe that accounts for every record: kept, duplicate or late (OP-66).

Spark's own watermark dedupe drops what is behind the watermark without a trace. Here a micro-batch is
split in three, each written under its ``(run_id, batch_id)`` folder, so that what was sent is always the sum:

* ``late``: records whose event time is before the watermark, the largest event time of the batches
  before less the delay, and records without an event time;
* ``kept``: of each other key the first record by event time, if the key wasn't kept within the delay;
* ``duplicates``: per key, how many more records there were.

A key that was kept is remembered until its event time plus the delay is behind the watermark, as in
Spark's state. The memory is the table of kept records itself: a batch reads, by the marks of one row a
batch, only the batches that still matter, and joins the keys it saw (one row each, after partial aggregation) to
them. A batch that is sent again reads the same earlier batches and replaces its own folders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import storage
from vigil.sinks.store import read_store, write_batch
from vigil.streaming.jobs import StreamResult, run_id_for, run_stream


@dataclass(frozen=True)
class Accounts:
    """The tables of one dedupe."""
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """``kept``, ``late`` (both with the stream's columns) or ``duplicates`` (key and ``n``)."""
        return read_store(spark, self.path(name))


def _marks(spark: SparkSession, tables: Accounts, run_id: int, batch_id: int) -> dict[int, object]:
    """The largest event time of each earlier batch of the run: one row a batch."""
    if not storage.names(spark, tables.path("marks")):
        return {}
    rows = tables.read(spark, "marks").where((F.col("run_id") == run_id) & (F.col("batch_id") < batch_id) & F.col("top").isNotNull())
    return {r.batch_id: r.top for r in rows.select("batch_id", F.col("top").cast("long").alias("s"), "top").collect()}


def _kept_within(spark: SparkSession, tables: Accounts, key: str, event_time: str, delay_s: int, marks: dict, run_id: int, watermark) -> DataFrame | None:
    """Keys that are still remembered; batches that ended before the watermark less the delay aren't opened."""
    horizon = watermark.timestamp() - delay_s
    live = [b for b, top in marks.items() if top.timestamp() > horizon]
    if not live or not storage.names(spark, tables.path("kept")):
        return None
    kept = tables.read(spark, "kept").where((F.col("run_id") == run_id) & F.col("batch_id").isin(live))
    return kept.where(F.col(event_time) + F.make_dt_interval(secs=F.lit(delay_s)) > F.lit(watermark)).select(key).distinct()


def dedupe_accounted(stream: DataFrame, key: str, event_time: str, delay_s: int, folder: str, checkpoint: str, available_now: bool = True) -> StreamResult:
    """Run the dedupe into ``folder``; read its tables with ``Accounts(folder)``. ``event_time`` is a TIMESTAMP."""
    spark, tables = stream.sparkSession, Accounts(folder)
    run_id = run_id_for(spark, checkpoint, tables.path("kept"))
    columns = stream.columns
    seen = {"batches": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        batch = batch.persist()
        try:
            top = batch.agg(F.max(event_time)).first()[0]
            marks = _marks(own, tables, run_id, batch_id)
            highest = max(marks.values(), default=None)
            behind, known = F.col(event_time).isNull(), None
            if highest is not None:
                watermark = own.range(1).select((F.lit(highest) - F.make_dt_interval(secs=F.lit(delay_s))).alias("w")).first().w
                behind = behind | (F.col(event_time) < F.lit(watermark))
                known = _kept_within(own, tables, key, event_time, delay_s, marks, run_id, watermark)
            write_batch(batch.where(behind), tables.path("late"), run_id, batch_id)
            rest = [c for c in columns if c != key]
            order = F.struct(event_time, F.xxhash64(*columns), *[F.col(c).cast("string") for c in rest])
            first = batch.where(~behind).groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("__first"), F.count("*").alias("__n"))
            if known is not None:  # a null key is a key like others
                known = known.select(F.col(key).alias("__key"), F.lit(True).alias("__old"))
                first = first.join(known, F.col(key).eqNullSafe(F.col("__key")), "left").withColumn("__old", F.coalesce("__old", F.lit(False)))
            else:
                first = first.withColumn("__old", F.lit(False))
            first = first.persist()
            write_batch(first.where(~F.col("__old")).select(key, "__first.*").select(*columns), tables.path("kept"), run_id, batch_id)
            more = F.col("__n") - F.when(F.col("__old"), 0).otherwise(1)
            write_batch(first.select(key, more.alias("n")).where("n > 0"), tables.path("duplicates"), run_id, batch_id)
            write_batch(own.range(1).select(F.lit(top).cast("timestamp").alias("top")), tables.path("marks"), run_id, batch_id)
            first.unpersist()
            seen["batches"] += 1
        finally:
            batch.unpersist()

    q = run_stream(stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint), available_now)
    return StreamResult(q.id, seen["batches"], run_id)
