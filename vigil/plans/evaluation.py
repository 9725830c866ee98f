"""Evaluation queries on embeddings (logits of a fixed linear model over whole vectors,
``label`` as the true class): accuracy, cross-entropy, confusion counts (OP-43, OP-44, OP-45, OP-77)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import evaluate as ev
from vigil.plans.catalog import query, t
from vigil.plans.features import SQL_LOGITS, fixed_logits

def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("vec_id", "label", fixed_logits("embedding").alias("logits"))
    return ev.score_logits(emb, "logits", "label")


@query("eval_accuracy", "OP-43 OP-77", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       round(avg(CASE WHEN list_position(z, m) - 1 = label THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS accuracy
FROM {SQL_LOGITS}
""")
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.accuracy(scored(spark, sf_dir))


@query("eval_cross_entropy", "OP-44 OP-77", f"""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       round(avg(m + ln(list_sum(list_transform(z, lambda x: exp(x - m)))) - z[label + 1]), 6) AS cross_entropy
FROM {SQL_LOGITS}
""")
def eval_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.mean_cross_entropy(scored(spark, sf_dir))


@query("confusion_matrix", "OP-45", f"""
SELECT label, CAST(list_position(z, m) - 1 AS INTEGER) AS prediction, CAST(count(*) AS BIGINT) AS n
FROM {SQL_LOGITS} GROUP BY 1, 2
""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion(scored(spark, sf_dir))


@query("eval_per_class", "OP-45 OP-77", f"""
WITH c AS (SELECT label, list_position(z, m) - 1 AS prediction FROM {SQL_LOGITS}),
cls AS (SELECT label AS cls FROM c UNION SELECT prediction FROM c),
k AS (SELECT cls.cls,
             CAST(count(*) FILTER (WHERE c.label = cls.cls AND c.prediction = cls.cls) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE c.label = cls.cls) AS BIGINT) AS n_actual,
             CAST(count(*) FILTER (WHERE c.prediction = cls.cls) AS BIGINT) AS n_pred
      FROM cls, c GROUP BY cls.cls)
SELECT CAST(cls AS INTEGER) AS cls, tp, n_actual, n_pred,
       round(CASE WHEN n_pred > 0 THEN tp / CAST(n_pred AS DOUBLE) END, 6) AS precision,
       round(CASE WHEN n_actual > 0 THEN tp / CAST(n_actual AS DOUBLE) END, 6) AS recall,
       round(CASE WHEN tp > 0 THEN 2.0 * tp / CAST(n_pred + n_actual AS DOUBLE) END, 6) AS f1
FROM k
""")
def eval_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 per class: one scan, one aggregate over the scored rows."""
    out = ev.class_metrics(ev.per_class_counts(scored(spark, sf_dir)))
    return out.select(F.col("cls").cast("int").alias("cls"), F.col("tp").cast("long").alias("tp"),
                      F.col("n_actual").cast("long").alias("n_actual"), F.col("n_pred").cast("long").alias("n_pred"),
                      F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"),
                      F.round("f1", 6).alias("f1"))
