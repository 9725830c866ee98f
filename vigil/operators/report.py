"""Batch bookkeeping and reporting (OP-24, OP-40, OP-54, OP-56, OP-75)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.ranking import global_row_number


def batch_counts(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    return df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_rows"))


def batch_order(df: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Numeric batch order (batch_2 before batch_10) with an explicit ordinal."""
    ids = df.select(batch_col).distinct()
    ordered = global_row_number(ids, [batch_col], out="ord")
    return ordered.select(batch_col, F.concat(F.lit("batch_"), F.col(batch_col).cast("string")).alias("batch_name"),
                          "ord")


def unseen(batches: DataFrame, seen: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Rows of batches not yet in the seen log (anti join on the batch id)."""
    return batches.join(seen.select(batch_col).distinct(), batch_col, "left_anti")


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """Concatenate batches whose column sets may differ (missing columns -> null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sensitive_report(pred: DataFrame, group_cols: list[str], sensitive_col: str = "sensitive") -> DataFrame:
    agg = pred.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_items"),
                                        F.sum(F.col(sensitive_col).cast("long")).alias("n_sensitive"))
    return agg.withColumn("sensitive_share", F.round(F.col("n_sensitive") / F.col("n_items"), 6))
