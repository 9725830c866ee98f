"""Seeded train/val/test splits and split counts (OP-41, OP-51, OP-52, OP-17).

``exact_split`` reproduces "shuffle with a seed, then cut at int(0.7 n) and
int(0.7 n) + int(0.15 n)" with a deterministic shuffle order (md5 of seed and key)
and no global window: a histogram over the first four hex digits of the hash (at most
65,536 rows, the one small result brought to the driver) locates the two cuts; rows
in whole buckets are labelled through a broadcast of that bounded histogram, and only
rows of the (at most two) boundary buckets are ranked, with the two-pass numbering.
Keys must be unique.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.config import SplitConfig
from vigil.operators.ranking import grouped_row_number

_BUCKET_DIGITS = 4


def shuffle_hash(key: Column | str, seed: int) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def hash_percentile(key: Column | str, seed: int) -> Column:
    """Stable bucket 0..99 from the first 8 hex digits of the shuffle hash."""
    return (hash_position(key, seed) % 100).cast("long")


def hash_position(key: Column | str, seed: int) -> Column:
    """Stable position 0..2**32-1 from the first 8 hex digits of the shuffle hash."""
    return F.conv(F.substring(shuffle_hash(key, seed), 1, 8), 16, 10).cast("long")


def hash_split(df: DataFrame, key: str, cfg: SplitConfig = SplitConfig(), out: str = "split") -> DataFrame:
    """Streaming-safe split: each row decides alone (no global count needed)."""
    p = hash_position(key, cfg.seed)
    train, val = (math.ceil(x * 2**32) for x in (cfg.train, cfg.train + cfg.val))
    return df.withColumn(out, F.when(p < train, "train").when(p < val, "val").otherwise("test"))


def split_sizes(n: int, cfg: SplitConfig = SplitConfig()) -> tuple[int, int, int]:
    """Exact sizes: int(train*n), int(val*n), remainder (double arithmetic)."""
    n_train = int(cfg.train * n)
    n_val = int(cfg.val * n)
    return n_train, n_val, n - n_train - n_val


def exact_split(df: DataFrame, key: str, cfg: SplitConfig = SplitConfig(), out: str = "split") -> DataFrame:
    h = shuffle_hash(key, cfg.seed)
    tagged = df.withColumn("__sp_h", h).withColumn(
        "__sp_b", F.conv(F.substring("__sp_h", 1, _BUCKET_DIGITS), 16, 10).cast("int"))
    hist = sorted(tuple(r) for r in tagged.groupBy("__sp_b").count().collect())  # <= 16**4 rows
    n = sum(c for _, c in hist)
    n_train, n_val, _ = split_sizes(n, cfg)
    cut1, cut2 = n_train, n_train + n_val

    def side(pos: int) -> str:
        return "train" if pos < cut1 else ("val" if pos < cut2 else "test")

    rows, start = [], 0
    for b, c in hist:
        end = start + c  # positions [start, end)
        whole = side(start) if side(start) == side(end - 1) else None
        rows.append((b, start, whole))
        start = end
    spark = df.sparkSession
    buckets = F.broadcast(spark.createDataFrame(rows, "__sp_b int, __sp_start long, __sp_whole string"))
    labelled = tagged.join(buckets, "__sp_b", "inner").select(*tagged.columns, "__sp_start", "__sp_whole")

    whole = labelled.where(F.col("__sp_whole").isNotNull()).withColumn(out, F.col("__sp_whole"))
    edge = labelled.where(F.col("__sp_whole").isNull())
    edge = grouped_row_number(edge, ["__sp_b"], ["__sp_h", key], out="__sp_rn")
    pos = F.col("__sp_start") + F.col("__sp_rn") - 1
    edge = edge.withColumn(out, F.when(pos < cut1, "train").when(pos < cut2, "val").otherwise("test"))
    cols = [*df.columns, out]
    return whole.select(*cols).unionByName(edge.select(*cols))


def split_counts(df: DataFrame, split_col: str = "split", label_col: str = "label") -> DataFrame:
    """Items per split and label with split subtotals and a grand total (rollup)."""
    return (df.rollup(split_col, label_col).agg(F.count(F.lit(1)).alias("n_items")))
