"""Micro-batch tables: keyed upsert, per-batch overwrite, landed batches, counts,
order, union, unseen (OP-04, OP-05, OP-09, OP-10, OP-20, OP-24, OP-40, OP-54, OP-56).

``events`` plays the message stream: key ``user_id``, batch ``event_id div 1000``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import report
from vigil.operators.joins import bounded_broadcast
from vigil.operators.split import hash_split
from vigil.operators.upsert import current_view, dedupe_in_batch
from vigil.plans.catalog import query, sql_hash_split, t
from vigil.sources.tables import heavy_table
from vigil.session import materialize, scratch_path
from vigil.sinks.keyed_table import KeyedTable
from vigil.sinks.store import read_store, write_batch

BATCH_ROWS = 1000
SEEN_UPTO = 4  # batches 0..4 are already in the seen log


def event_batches(spark: SparkSession, sf_dir: str, cols: tuple[str, ...] = ("event_id", "user_id", "event_type",
                                                                             "value")) -> DataFrame:
    ev = t(spark, sf_dir, "events").select(*cols)
    return ev.withColumn("batch_id", F.floor(F.col("event_id") / BATCH_ROWS).cast("long"))


@query("keyed_upsert", "OP-09", f"""
SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
       arg_max(value, event_id) AS value, CAST(arg_max(event_id // {BATCH_ROWS}, event_id) AS BIGINT) AS batch_id
FROM events GROUP BY user_id
""")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_batches(spark, sf_dir).withColumn("run_id", F.lit(0).cast("long"))
    # last (run, batch) wins, in-batch duplicates resolved by event order: one
    # aggregation over the lexicographic version (run_id, batch_id, event_id), i.e. one
    # shuffle with partial aggregation (a hot key costs one row per task)
    view = current_view(ev, "user_id", version_cols=("run_id", "batch_id", "event_id"))
    return view.select("user_id", "event_id", "event_type", "value", "batch_id")


@query("batch_overwrite", "OP-10", f"""
SELECT CAST(event_id // {BATCH_ROWS} AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_rows
FROM events GROUP BY 1
""")
def batch_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every batch, then replay batch 3: dynamic overwrite keeps it idempotent."""
    path = scratch_path(spark, "landed")
    ev = event_batches(spark, sf_dir).withColumn("run_id", F.lit(0).cast("long"))
    (ev.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "batch_id").parquet(path))
    replay = ev.where(F.col("batch_id") == 3).drop("run_id", "batch_id")
    write_batch(replay, path, run_id=0, batch_id=3)
    return report.batch_counts(read_store(spark, path))


@query("batch_counts", "OP-40", f"""
SELECT CAST(event_id // {BATCH_ROWS} AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_rows
FROM events GROUP BY 1
""")
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.batch_counts(event_batches(spark, sf_dir, ("event_id",)))


@query("batch_order", "OP-54", f"""
SELECT batch_id, 'batch_' || CAST(batch_id AS VARCHAR) AS batch_name,
       CAST(row_number() OVER (ORDER BY batch_id) AS BIGINT) AS ord
FROM (SELECT DISTINCT CAST(event_id // {BATCH_ROWS} AS BIGINT) AS batch_id FROM events)
""")
def batch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.batch_order(event_batches(spark, sf_dir, ("event_id",)))


@query("landed_batches", "OP-05 OP-20", f"""
SELECT CAST(event_id // {BATCH_ROWS} AS BIGINT) AS batch_id, event_id, event_type FROM events
""")
def landed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land batches under (run_id, batch_id) and scan all of them back (every part file)."""
    path = scratch_path(spark, "landed")
    ev = event_batches(spark, sf_dir, ("event_id", "event_type")).withColumn("run_id", F.lit(0).cast("long"))
    ev.write.mode("overwrite").partitionBy("run_id", "batch_id").parquet(path)
    return read_store(spark, path).select("batch_id", "event_id", "event_type")


@query("union_batches", "OP-56", f"""
SELECT event_id, CAST(event_id // {BATCH_ROWS} AS BIGINT) AS batch_id, event_type,
       CASE WHEN (event_id // {BATCH_ROWS}) % 2 = 0 THEN value END AS value
FROM events
""")
def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_batches(spark, sf_dir, ("event_id", "event_type", "value"))
    even = ev.where(F.col("batch_id") % 2 == 0).select("event_id", "batch_id", "event_type", "value")
    odd = ev.where(F.col("batch_id") % 2 == 1).select("event_id", "batch_id", "event_type")  # older producer
    return report.union_batches([even, odd])


@query("incremental_unseen", "OP-24", f"""
SELECT event_id, CAST(event_id // {BATCH_ROWS} AS BIGINT) AS batch_id FROM events
WHERE event_id // {BATCH_ROWS} > {SEEN_UPTO}
""")
def incremental_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = event_batches(spark, sf_dir, ("event_id",))
    # the log of batches seen is a stored table, as a job keeps it; one row a batch
    seen = materialize(ev.select("batch_id").where(F.col("batch_id") <= SEEN_UPTO).distinct(), "seen_batches")
    return report.unseen(ev, bounded_broadcast(seen, 1_000_000))


@query("feature_store_scan", "OP-04 OP-09", f"""
SELECT doc_id, lang, split, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_words
FROM (SELECT doc_id, lang, text, {sql_hash_split('doc_id')} AS split FROM documents)
WHERE split = 'val'
""")
def feature_store_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write features in four micro-batches (the last replays the first; each holds older
    versions of its rows, too, of which the last written one must win), then scan the
    current view of the val split."""
    docs = hash_split(heavy_table(spark, sf_dir, "documents", "doc_id", "lang", "text"), "doc_id")
    feats = docs.select("doc_id", "lang", "split", F.size(F.split("text", " ")).cast("long").alias("n_words"))
    part = F.col("doc_id") % 3
    versions = feats.withColumn("version", F.lit(1)).unionByName(feats.select(
        "doc_id", "lang", "split", F.lit(-1).cast("long").alias("n_words"), F.lit(0).alias("version")))
    table = KeyedTable.create(spark, scratch_path(spark, "store"), "doc_id", versions.schema, by=("split",))
    for b, p in enumerate((0, 1, 2, 0)):
        table.upsert(dedupe_in_batch(versions.where(part == p), "doc_id", "version"), run_id=0, batch_id=b)
    # a document's split never changes, so the filter prunes partitions below the view
    return table.current(F.col("split") == "val").select("doc_id", "lang", "split", "n_words")


def _order_table(spark: SparkSession, sf_dir: str) -> KeyedTable:
    """Orders by customer in three batches; the second is sent again with fewer rows, the third with none,
    then the first two commits are folded and a fourth batch arrives."""
    orders = t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("double").alias("price"))
    part = F.col("o_orderkey") % 4
    table = KeyedTable.create(spark, scratch_path(spark, "orders"), "o_custkey", orders.schema)

    def send(rows: DataFrame, batch: int) -> None:
        table.upsert(dedupe_in_batch(rows, "o_custkey", "o_orderkey"), 0, batch)

    for b in range(3):
        send(orders.where(part == b), b)
    send(orders.where((part == 1) & (F.col("o_orderkey") % 3 == 0)), 1)
    send(orders.where("false"), 2)
    table.compact()
    send(orders.where(part == 3), 3)
    return table


_SQL_ORDERS = """
WITH sent AS (
  SELECT o_custkey, o_orderkey, CAST(o_totalprice AS DOUBLE) AS price, o_orderkey % 4 AS batch_id FROM orders
  WHERE o_orderkey % 4 IN (0, 3) OR (o_orderkey % 4 = 1 AND o_orderkey % 3 = 0)),
cur AS (SELECT * FROM sent QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY batch_id DESC, o_orderkey DESC) = 1)
"""


@query("store_replay", "OP-09 OP-10", _SQL_ORDERS + "SELECT o_custkey, o_orderkey, price, CAST(batch_id AS BIGINT) AS batch_id FROM cur")
def store_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay with fewer rows, or none, leaves none of its earlier rows behind."""
    return _order_table(spark, sf_dir).current().select("o_custkey", "o_orderkey", "price", "batch_id")


@query("store_lookup", "OP-04 OP-09", _SQL_ORDERS + """SELECT o_custkey, o_orderkey, price FROM cur
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current rows of one segment's customers, from the files that may hold them."""
    keys = t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return _order_table(spark, sf_dir).lookup(keys).select("o_custkey", "o_orderkey", "price")
