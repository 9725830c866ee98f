"""Element-wise mean pooling of vectors by key (OP-42).

``posexplode`` + ``groupBy(key, pos).avg`` runs in one codegen stage with partial
aggregation before the shuffle, so a hot key costs at most one row per (key, pos)
per task in the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_pool_long(df: DataFrame, keys: list[str], vec: str, pos: str = "pos",
                   out: str = "mean") -> DataFrame:
    """``keys, pos, mean`` with one row per key and vector position (0-based)."""
    exploded = df.select(*keys, F.posexplode(vec).alias(pos, "__mp_x"))
    return exploded.groupBy(*keys, pos).agg(F.avg(F.col("__mp_x").cast("double")).alias(out))


def mean_pool(df: DataFrame, keys: list[str], vec: str, out: str = "mean_vec",
              divisor: int | None = None) -> DataFrame:
    """``keys, out`` where ``out`` is the element-wise mean vector.

    ``divisor`` fixes the count (e.g. k sampled frames including zero padding that is
    not materialised); by default the number of vectors per key is used.
    """
    exploded = df.select(*keys, F.posexplode(vec).alias("__mp_pos", "__mp_x"))
    agg = F.sum(F.col("__mp_x").cast("double"))
    value = agg / F.lit(float(divisor)) if divisor else F.avg(F.col("__mp_x").cast("double"))
    per_pos = exploded.groupBy(*keys, "__mp_pos").agg(value.alias("__mp_v"))
    # one row per (key, position): the re-assembly groups at most `dim` rows per key
    return (per_pos.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("__mp_pos", "__mp_v"))).alias("__mp_s"))
            .select(*keys, F.transform("__mp_s", lambda s: s["__mp_v"].cast("float")).alias(out)))


def mean_pool_vector(df: DataFrame, keys: list[str], vec: str, out: str = "mean_vec") -> DataFrame:
    """Element-wise mean of wide vectors with MLlib's ``Summarizer``: one imperative
    aggregate per key with partial aggregation, and no explode (the row count never
    grows by the vector width before the shuffle). Returns ``keys, out`` as array<double>."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vectors = df.select(*keys, array_to_vector(F.col(vec).cast("array<double>")).alias("__mp_v"))
    pooled = vectors.groupBy(*keys).agg(Summarizer.mean(F.col("__mp_v")).alias("__mp_m"))
    return pooled.select(*keys, vector_to_array("__mp_m").alias(out))
