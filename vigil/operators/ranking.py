"""Row numbering without a single-task window (OP-50, OP-54; boundary ranks of OP-51).

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task; with a few
groups holding most of the data (a class or split can hold a third of all rows) that
task becomes the job. Here the numbering is done in two passes:

1. range-partition by (group, order) and sort within partitions, tag each row with its
   partition id and its position inside the partition, then checkpoint (reliably, in
   the shared folder) so both passes see one fixed partitioning;
2. per (group, partition) count and first position -> running offset of each
   partition inside its group, computed on that small frame (one row per group and
   partition), joined back; number = offset + position - first position + 1.

A hot group is spread over many range partitions, so no task holds more than one
partition's worth of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.joins import bounded_broadcast
from vigil.session import materialize

_PID, _POS, _MIN, _OFF, _N = "__rk_pid", "__rk_pos", "__rk_min", "__rk_off", "__rk_n"


def grouped_row_number(df: DataFrame, group_cols: list[str], order_cols: list[str],
                       out: str = "rn", num_partitions: int | None = None,
                       max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """``row_number() over (partition by group_cols order by order_cols)`` (1-based).

    ``order_cols`` must make the order total within a group (include a unique key).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    ranged = (df.repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id()))
    ranged = materialize(ranged)

    stats = ranged.groupBy(*group_cols, _PID).agg(F.min(_POS).alias(_MIN), F.count(F.lit(1)).alias(_N))
    before = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn(_OFF, F.coalesce(F.sum(_N).over(before), F.lit(0))).drop(_N)
    # one row per (group, partition): small by construction, so the count decides
    offsets = bounded_broadcast(offsets, max_broadcast_rows, use_estimate=False)

    # offsets derive from `ranged`; alias both sides so the self-join resolves
    r, o = ranged.alias("__rk_r"), offsets.alias("__rk_o")
    cond = F.col(f"__rk_r.{_PID}") == F.col(f"__rk_o.{_PID}")
    for c in group_cols:
        cond = cond & F.col(f"__rk_r.{c}").eqNullSafe(F.col(f"__rk_o.{c}"))
    joined = r.join(o, cond, "inner")
    cols = [F.col(f"__rk_r.{c}").alias(c) for c in df.columns]
    number = (F.col(f"__rk_o.{_OFF}") + F.col(f"__rk_r.{_POS}") - F.col(f"__rk_o.{_MIN}") + 1).cast("long")
    return joined.select(*cols, number.alias(out))


def global_row_number(df: DataFrame, order_cols: list[str], out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Total order numbering (1-based) without collecting into one partition."""
    return grouped_row_number(df, [], order_cols, out=out, num_partitions=num_partitions)


def dense_index(values: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """0-based rank of each distinct value in sorted order (class index of a value set)."""
    distinct = values.select(col).where(F.col(col).isNotNull()).distinct()
    ranked = global_row_number(distinct, [col], out="__rk_rn")
    return ranked.select(col, (F.col("__rk_rn") - 1).cast("int").alias(out))
