"""Moderation report and flagged rows (OP-75, OP-33) over documents and their labels.

Predictions for documents come from ``labels``: toxic -> class ``offensive``
(sensitive), otherwise ``normal``, unlabelled documents included. Only ``doc_id`` and the grouping/display columns
of ``documents`` are read (the text column is pruned at the scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.labels import decode_label, encode_label, sensitive_flag
from vigil.plans.catalog import query, t


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = t(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    idx = F.when(F.col("toxic") == 1, encode_label(F.lit("offensive"))).otherwise(encode_label(F.lit("normal")))
    return (lab.withColumn("prediction", idx)
            .withColumn("predicted_label", decode_label("prediction"))
            .withColumn("sensitive", sensitive_flag("predicted_label")))


def with_predictions(docs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its prediction; one without a label counts as ``normal``."""
    joined = docs.join(predictions(spark, sf_dir), "doc_id", "left")
    label = F.coalesce("predicted_label", F.lit("normal"))
    return joined.withColumn("predicted_label", label).withColumn("sensitive", sensitive_flag("predicted_label"))


def moderation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = with_predictions(docs, spark, sf_dir)
    agg = joined.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(F.col("sensitive").cast("long")).alias("n_sensitive"),
        F.sum(F.coalesce(F.col("quality") == 0, F.lit(False)).cast("long")).alias("n_low_quality"))
    return agg.withColumn("sensitive_share", F.round(F.col("n_sensitive") / F.col("n_items"), 6))


query("moderation_report", "OP-75 OP-33 OP-22 OP-32", """
SELECT d.lang,
       CAST(count(*) AS BIGINT) AS n_items,
       CAST(sum(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_sensitive,
       CAST(sum(CASE WHEN l.quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_low_quality,
       round(sum(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE), 6) AS sensitive_share
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY d.lang
""")(moderation_report)


@query("flagged_rows", "OP-75 OP-33", """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, 'offensive' AS predicted_label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE l.toxic = 1
""")
def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    # filter on the stored column so it reaches the Parquet scan as a pushed filter
    flagged = predictions(spark, sf_dir).where(F.col("toxic") == 1)
    return docs.join(flagged, "doc_id", "inner").select(
        "doc_id", "lang", "source", "n_chars", "quality", "predicted_label")


LANDING_BATCH = 1000  # documents land in micro-batches of this many ids


@query("batch_report", "OP-75 OP-40 OP-33", f"""
SELECT CAST(d.doc_id // {LANDING_BATCH} AS BIGINT) AS batch_id,
       CASE WHEN l.toxic = 1 THEN 'offensive' ELSE 'normal' END AS predicted_label,
       CAST(count(*) AS BIGINT) AS n_items,
       CAST(sum(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_sensitive,
       round(sum(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE), 6) AS sensitive_share
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY 1, 2
""")
def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per landed batch and predicted class: items, sensitive items and their share."""
    from vigil.operators.report import sensitive_report

    docs = t(spark, sf_dir, "documents").select(
        "doc_id", F.floor(F.col("doc_id") / LANDING_BATCH).cast("long").alias("batch_id"))
    pred = with_predictions(docs, spark, sf_dir)
    return sensitive_report(pred, ["batch_id", "predicted_label"])
