"""Scan of the input tables (one Parquet dataset per table).

Only ``read.parquet`` is used: column pruning and predicate pushdown reach the scan
because callers select/filter on the returned DataFrame lazily.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def heavy_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Pruned scan of ``cols`` for CPU-heavy row-wise work. Tasks follow the file splits
    (``spark.sql.files.maxPartitionBytes``, ``minPartitionNum``); texts are never shuffled
    to make more of them."""
    return table(spark, sf_dir, name).select(*cols)
