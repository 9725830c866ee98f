"""Per-batch landing (OP-10, OP-05): Parquet under ``run_id=<r>/batch_id=<b>``.

A batch owns its folder: writing it replaces the folder's files as one job, so a replayed
batch replaces itself, also where it has fewer rows or none, and a new checkpoint (new
``run_id``, batch ids restarting at 0) never overwrites an older run's batch 0. Keyed
tables with transactions are in ``keyed_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_batch(df: DataFrame, path: str, run_id: int, batch_id: int) -> None:
    """Overwrite exactly the (run_id, batch_id) folder with ``df``."""
    df.drop("run_id", "batch_id").write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={int(run_id)}/batch_id={int(batch_id)}")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Scan of a (run_id, batch_id)-partitioned table; partition discovery infers small
    ints, so the version columns are cast back to bigint."""
    df = spark.read.parquet(path)
    for c in ("run_id", "batch_id"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("long"))
    return df
