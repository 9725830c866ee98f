"""Evaluation over scored rows: accuracy, mean cross-entropy, confusion counts,
per-class precision/recall (OP-43, OP-44, OP-45, OP-77).

Everything is one aggregate (partial aggregation before the shuffle); predictions
are never collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.scoring import argmax, cross_entropy


def score_logits(df: DataFrame, logits: str, label: str) -> DataFrame:
    return (df.withColumn("prediction", argmax(logits))
            .withColumn("loss", cross_entropy(logits, label)))


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(hit) * 100.0, 6).alias("accuracy"))


def mean_cross_entropy(scored: DataFrame, loss: str = "loss") -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(loss), 6).alias("cross_entropy"))


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def per_class_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``cls, tp, n_actual, n_pred`` from the scored rows in one aggregate: every row
    contributes to its true class and to its predicted class (partial aggregation,
    one shuffle of at most classes rows per task)."""
    hit = (F.col(label) == F.col(prediction)).cast("long")
    parts = F.array(
        F.struct(F.col(label).alias("cls"), hit.alias("tp"), F.lit(1).cast("long").alias("a"),
                 F.lit(0).cast("long").alias("p")),
        F.struct(F.col(prediction).alias("cls"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("a"),
                 F.lit(1).cast("long").alias("p")))
    rows = scored.select(F.explode(parts).alias("x")).select("x.*")
    return rows.groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("a").alias("n_actual"), F.sum("p").alias("n_pred"))


def class_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 from ``per_class_counts``."""
    precision = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred"))
    recall = F.when(F.col("n_actual") > 0, F.col("tp") / F.col("n_actual"))
    f1 = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("n_pred") + F.col("n_actual")))
    return counts.select("cls", "tp", "n_actual", "n_pred", precision.alias("precision"), recall.alias("recall"),
                         f1.alias("f1"))
