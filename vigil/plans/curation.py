"""Curation: class index, seeded splits, split counts/filter, rename plan, manifests,
directory scan, label encode/decode/quarantine
(OP-03, OP-06, OP-11, OP-17, OP-21, OP-22, OP-32, OP-33, OP-41, OP-50, OP-51, OP-52)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.labels import decode_label, encode_label, quarantine_status, sensitive_flag
from vigil.operators.joins import bounded_broadcast
from vigil.operators.ranking import dense_index, grouped_row_number
from vigil.operators.split import exact_split, hash_percentile, hash_split, split_counts as rollup_counts
from vigil.plans.catalog import SQL_CLASS_LIST, SQL_SENSITIVE_LIST, query, sql_hash_split, sql_pct, t
from vigil.session import scratch_path
from vigil.sources.files import scan_media
from vigil.sources.manifest import write_manifest

# --- fixed values --------------------------------------------------------------------
# Event-type dictionary used to exercise label encoding; "view" is deliberately absent
# so that unknown labels (-1) occur.
EVENT_CLASSES = ["click", "error", "purchase", "signup"]
# --------------------------------------------------------------------------------------


@query("class_index_sorted", "OP-06", """
SELECT d.doc_id, d.lang, CAST(r.class_idx AS INTEGER) AS class_idx
FROM documents d
JOIN (SELECT lang, dense_rank() OVER (ORDER BY lang) - 1 AS class_idx
      FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)) r ON d.lang = r.lang
""")
def class_index_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id", "lang")
    index = bounded_broadcast(dense_index(docs, "lang", out="class_idx"), 100_000)
    return docs.join(index, "lang", "inner").select("doc_id", "lang", "class_idx")


@query("split_exact", "OP-51", """
WITH h AS (SELECT doc_id, md5('42:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
r AS (SELECT doc_id, row_number() OVER (ORDER BY h, doc_id) - 1 AS pos, count(*) OVER () AS n FROM h)
SELECT doc_id,
       CASE WHEN pos < floor(0.7::DOUBLE * n) THEN 'train'
            WHEN pos < floor(0.7::DOUBLE * n) + floor(0.15::DOUBLE * n) THEN 'val'
            ELSE 'test' END AS split
FROM r
""")
def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id")
    return exact_split(docs, "doc_id")


@query("split_hash", "OP-52", f"""
SELECT doc_id, CAST({sql_pct('doc_id')} AS BIGINT) AS bucket, {sql_hash_split('doc_id')} AS split
FROM documents
""")
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id")
    return hash_split(docs, "doc_id").withColumn("bucket", hash_percentile("doc_id", 42))


@query("split_counts", "OP-41", f"""
SELECT {sql_hash_split('doc_id')} AS split, lang, CAST(count(*) AS BIGINT) AS n_items
FROM documents GROUP BY ROLLUP ({sql_hash_split('doc_id')}, lang)
""")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = hash_split(t(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return rollup_counts(docs, "split", "lang")


@query("split_filter", "OP-17", f"""
SELECT doc_id, lang, split FROM (
  SELECT doc_id, lang, {sql_hash_split('doc_id')} AS split FROM documents) WHERE split = 'val'
""")
def split_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store partitioned by split, read back with a partition filter (pruned scan)."""
    docs = hash_split(t(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    path = scratch_path(spark, "split_store")
    docs.write.mode("overwrite").partitionBy("split").parquet(path)
    return spark.read.parquet(path).where(F.col("split") == "val").select("doc_id", "lang", "split")


@query("rename_plan", "OP-50", """
SELECT doc_id, source, lang, CAST(i AS BIGINT) AS i,
       source || '_' || lang || '_' || CAST(i AS VARCHAR) || '.mp4' AS new_name
FROM (SELECT doc_id, source, lang,
             row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) - 1 AS i
      FROM documents)
""")
def rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    numbered = grouped_row_number(docs, ["source", "lang"], ["doc_id"], out="rn")
    i = (F.col("rn") - 1).cast("long")
    return numbered.select("doc_id", "source", "lang", i.alias("i"),
                           F.concat_ws("_", "source", "lang", i.cast("string")).alias("__n")) \
        .withColumn("new_name", F.concat("__n", F.lit(".mp4"))).drop("__n")


def _event_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = t(spark, sf_dir, "events").select("event_id", "event_type")
    return ev.withColumn("label_idx", encode_label("event_type", EVENT_CLASSES))


_SQL_EVENT_IDX = ("CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 "
                  "WHEN 'signup' THEN 3 ELSE -1 END")


@query("label_encode", "OP-22", f"""
SELECT event_id, event_type, CAST({_SQL_EVENT_IDX} AS INTEGER) AS label_idx FROM events
""")
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_labels(spark, sf_dir)


@query("label_quarantine", "OP-21", f"""
SELECT event_id, CAST({_SQL_EVENT_IDX} AS INTEGER) AS label_idx,
       CASE WHEN {_SQL_EVENT_IDX} >= 0 THEN 'train' ELSE 'quarantine' END AS status
FROM events
""")
def label_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_labels(spark, sf_dir).select("event_id", "label_idx", quarantine_status().alias("status"))


@query("label_decode", "OP-32", f"""
SELECT vec_id, label, {SQL_CLASS_LIST}[label + 1] AS label_name FROM embeddings
""")
def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("vec_id", "label")
    return emb.withColumn("label_name", decode_label("label"))


@query("sensitive_flag", "OP-33", f"""
SELECT vec_id, {SQL_CLASS_LIST}[label + 1] AS label_name,
       coalesce(list_contains({SQL_SENSITIVE_LIST}, {SQL_CLASS_LIST}[label + 1]), false) AS sensitive
FROM embeddings
""")
def sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("vec_id", "label")
    named = emb.select("vec_id", decode_label("label").alias("label_name"))
    return named.withColumn("sensitive", sensitive_flag("label_name"))


@query("manifest_write", "OP-11 OP-41", f"""
SELECT {sql_hash_split('page_id')} AS split, CAST(count(*) AS BIGINT) AS n_items
FROM pages GROUP BY 1
""")
def manifest_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.plans.envelopes import page_items

    items = page_items(spark, sf_dir).withColumn("idx", F.concat_ws("_", "label", F.col("page_id").cast("string")))
    return write_manifest(items.select("idx", "url", "label", "split"), scratch_path(spark, "manifest"))


@query("directory_scan", "OP-03")
def directory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive listing of the table folder with an extension filter (no contents read)."""
    return scan_media(spark, sf_dir, [".parquet"]).select("path", "length", "ext")
