"""Incremental report (OP-75, OP-40): a streaming aggregation whose state lives in Spark's state store.

In update mode each trigger gives only the groups that it changed; they are upserted by key into a keyed table as
one commit, which a trigger that runs again replaces. So the report always equals the batch report over what
has arrived, whatever the cut into triggers, and a trigger's work grows with its own rows. A new checkpoint counts
from the start: each run has a table of its own, and the newest run is the one that is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil import storage
from vigil.sinks.keyed_table import KeyedTable
from vigil.streaming.jobs import StreamResult, run_id_for, run_stream

KEY = "report_key"


def _table(folder: str, run_id: int) -> str:
    return f"{folder.rstrip('/')}/run-{run_id}"


def report_as_it_arrives(stream: DataFrame, keys: list[str], measures: list[Column], folder: str, checkpoint: str,
                         available_now: bool = True) -> StreamResult:
    """Keep ``measures`` (named aggregates) by ``keys`` in ``folder``; a null key is a group of its own."""
    run_id = run_id_for(stream.sparkSession, checkpoint, folder)
    seen = {"batches": 0}

    def process(changed: DataFrame, batch_id: int) -> None:
        rows = changed.withColumn(KEY, F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
        KeyedTable.open_or_create(rows.sparkSession, _table(folder, run_id), KEY, rows.schema, buckets=1).upsert(rows, run_id, batch_id)
        seen["batches"] += 1

    counted = stream.groupBy(*keys).agg(*measures)
    q = run_stream(counted.writeStream.outputMode("update").foreachBatch(process).option("checkpointLocation", checkpoint), available_now)
    return StreamResult(q.id, seen["batches"], run_id)


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of the newest run: its keys and measures, and ``batch_id``, the trigger that changed a group last."""
    runs = [int(n.split("-", 1)[1]) for n in storage.names(spark, folder) if n.startswith("run-")]
    if not runs:
        raise ValueError(f"no report in {folder}")
    return KeyedTable.open(spark, _table(folder, max(runs))).current().drop(KEY, "run_id")


def newest_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The groups that the latest trigger changed."""
    rows = read_report(spark, folder)
    return rows.join(F.broadcast(rows.agg(F.max("batch_id").alias("batch_id"))), "batch_id")
