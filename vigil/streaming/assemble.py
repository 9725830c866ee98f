"""Put messages that were sent in parts together again (OP-01, OP-08).

``assemble`` reads ``key, value`` records of ``sinks/chunks.py``. A micro-batch writes, each under its
``(run_id, batch_id)`` folder:

* ``delivered``: ``key, value, message``: whole records, and messages whose parts are all there and whose bytes have
  the right digest;
* ``undeliverable``: ``key, message, parts, received, reason``: ``incomplete`` (parts missing for ``wait_batches``
  batches) or ``corrupt`` (wrong digest, or a part number out of range);
* ``parts``: the parts that came, with their bytes, which are written this once and moved once more, when their
  message is complete;
* ``waiting``: which parts of messages still on their way have come (no bytes), the state that the next batch reads. The
  state of a batch depends only on that of the batch before it, so a batch that is sent again replaces itself.

Repeated parts count once; parts of a message delivered within ``wait_batches`` batches are ignored. A whole
record that is sent twice is delivered twice, as by any topic: the keyed table behind it keeps one. Copies of a part collapse
before they are put together, and a group holds the parts of one message, so no key or repeated message fills a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import storage
from vigil.operators.joins import with_ids
from vigil.sinks.chunks import parsed
from vigil.sinks.store import read_store, write_batch
from vigil.streaming.jobs import StreamResult, run_id_for, run_stream

PARTS = ("key", "message", "parts", "part", "since")
MESSAGE = ("key", "message", "parts")


@dataclass(frozen=True)
class Messages:
    """The tables of one assembly."""
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """``delivered`` or ``undeliverable``, all batches."""
        return read_store(spark, self.path(name))

    def batches(self, spark: SparkSession, name: str, run_id: int) -> list[int]:
        return sorted(int(n.split("=", 1)[1]) for n in storage.names(spark, f"{self.path(name)}/run_id={run_id}") if n.startswith("batch_id="))

    def state(self, spark: SparkSession, run_id: int, batch_id: int) -> DataFrame:
        """The parts that were waiting after a batch, without their bytes."""
        return spark.read.parquet(f"{self.path('waiting')}/run_id={run_id}/batch_id={batch_id}")

    def waiting(self, spark: SparkSession, run_id: int = 0) -> DataFrame:
        """Messages whose parts hadn't all come when the latest batch of a run ended: one row each."""
        rows = self.state(spark, run_id, self.batches(spark, "waiting", run_id)[-1])
        return rows.groupBy("key", "message", "parts").agg(F.count("*").cast("int").alias("received"))


def _joined(pieces) -> F.Column:
    """The bytes of an array of parts, in order, in one pass."""
    return F.unhex(F.array_join(F.transform(F.array_sort(pieces), lambda p: F.hex(p["body"])), ""))


def _values(stored: DataFrame, complete: DataFrame) -> DataFrame:
    """``key, message, parts, value`` of the ``complete`` messages, from the ``stored`` parts. The bytes move once, by a
    hash of their message; parts of other messages stay where they are."""
    wanted = complete.select(F.xxhash64(*MESSAGE).alias("id"), F.struct(*MESSAGE).alias("wanted"), "since")
    rows = with_ids(stored.select(F.xxhash64(*MESSAGE).alias("id"), *MESSAGE, "part", "body", "batch_id"), wanted.select("id"))
    # an id that two messages share is no match; no key of the join, which would move the bytes again
    same = F.coalesce(F.struct(*MESSAGE).eqNullSafe(F.col("wanted")), F.lit(False))
    # parts from before were given up with the message that they came for
    once = rows.join(wanted, "id").where(same & (F.col("batch_id") >= F.col("since"))).groupBy("id", *MESSAGE, "part").agg(F.first("body").alias("body"))
    return once.groupBy("id", *MESSAGE).agg(_joined(F.collect_list(F.struct("part", "body"))).alias("value")).drop("id")


def assemble(records: DataFrame, folder: str, checkpoint: str, wait_batches: int = 100, available_now: bool = True) -> StreamResult:
    """Run the assembly into ``folder``; read its tables with ``Messages(folder)``."""
    tables = Messages(folder)
    run_id = run_id_for(records.sparkSession, checkpoint, tables.path("delivered"))
    seen = {"batches": 0}

    def process(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        rows = parsed(batch.select("key", "value")).persist()
        came = rows.where(F.col("message").isNotNull())
        write_batch(came.select(*MESSAGE, "part", "body"), tables.path("parts"), run_id, batch_id)
        parts = came.withColumn("since", F.lit(batch_id)).select(*PARTS)
        if batch_id - 1 in tables.batches(own, "waiting", run_id):
            parts = parts.unionByName(tables.state(own, run_id, batch_id - 1))
        if tables.batches(own, "delivered", run_id):
            earlier = tables.read(own, "delivered").where((F.col("run_id") == run_id) & F.col("batch_id").between(batch_id - wait_batches, batch_id - 1))
            ids = earlier.where(F.col("message").isNotNull()).select(F.col("key").alias("__key"), F.col("message").alias("__message"))
            parts = parts.join(ids, (F.col("message") == F.col("__message")) & F.col("key").eqNullSafe(F.col("__key")), "left_anti")
        once = parts.groupBy("key", "message", "parts", "part").agg(F.min("since").alias("since"))
        groups = once.groupBy(*MESSAGE).agg(F.count("*").cast("int").alias("received"), F.min("since").alias("since"), F.collect_list(F.struct("part", F.col("since").alias("came"))).alias("pieces"))
        in_range = (F.array_min("pieces.part") >= 0) & (F.array_max("pieces.part") < F.col("parts"))
        state = (F.when(~in_range, "corrupt").when(F.col("received") == F.col("parts"), "complete")
                 .when(F.col("since") <= batch_id - wait_batches, "incomplete").otherwise("waiting"))
        groups = groups.withColumn("state", state).persist()
        complete = groups.where("state = 'complete'")
        stored = tables.read(own, "parts").where((F.col("run_id") == run_id) & F.col("batch_id").between(batch_id - wait_batches, batch_id))
        values = _values(stored, complete).withColumn("right", F.md5("value") == F.col("message")).persist()
        try:
            whole = rows.where(F.col("message").isNull()).select("key", "value", "message")
            write_batch(whole.unionByName(values.where("right").select("key", "value", "message")), tables.path("delivered"), run_id, batch_id)
            lost = groups.where("state IN ('corrupt', 'incomplete')").select(*MESSAGE, "received", F.col("state").alias("reason"))
            wrong = values.where("NOT right").select(*MESSAGE, F.col("parts").alias("received"), F.lit("corrupt").alias("reason"))
            write_batch(lost.unionByName(wrong), tables.path("undeliverable"), run_id, batch_id)
            rest = groups.where("state = 'waiting'").select(*MESSAGE, "since", F.inline("pieces"))
            write_batch(rest.select(*PARTS), tables.path("waiting"), run_id, batch_id)
            if batch_id >= 2:  # only the batch before can be asked for again
                storage.delete(own, f"{tables.path('waiting')}/run_id={run_id}/batch_id={batch_id - 2}")
            if batch_id >= wait_batches + 2:  # no message waits so long
                storage.delete(own, f"{tables.path('parts')}/run_id={run_id}/batch_id={batch_id - wait_batches - 2}")
            seen["batches"] += 1
        finally:
            values.unpersist()
            groups.unpersist()
            rows.unpersist()

    q = run_stream(records.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint), available_now)
    return StreamResult(q.id, seen["batches"], run_id)
