"""Label encode/decode, sensitive flag, unknown-class routing (OP-21, OP-22, OP-32, OP-33).

Class lists are tiny and fixed, so the default forms are plain expressions that stay
inside whole-stage codegen (no join at all). ``encode_with_dimension`` is the join form
for a dimension DataFrame whose size is only known at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.joins import bounded_broadcast
from vigil.schemas import CLASS_NAMES, SENSITIVE_CLASSES

UNKNOWN = -1


def encode_label(label: Column | str, names: list[str] = CLASS_NAMES) -> Column:
    """Class name -> index in ``names``; unknown or null -> -1."""
    label = F.col(label) if isinstance(label, str) else label
    pos = F.array_position(F.array(*[F.lit(n) for n in names]), label)
    return F.coalesce(pos.cast("int") - 1, F.lit(UNKNOWN))


def decode_label(idx: Column | str, names: list[str] = CLASS_NAMES) -> Column:
    """Index -> class name; out of range (including -1) or null -> null."""
    idx = F.col(idx) if isinstance(idx, str) else idx
    return F.get(F.array(*[F.lit(n) for n in names]), idx.cast("int"))


def sensitive_flag(label: Column | str, sensitive: list[str] = SENSITIVE_CLASSES) -> Column:
    """True for sensitive classes; null label -> False."""
    label = F.col(label) if isinstance(label, str) else label
    return F.coalesce(label.isin(*sensitive), F.lit(False))


def encode_with_dimension(df: DataFrame, label_col: str, dim: DataFrame, out: str = "label_idx",
                          max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Left join on a (label, label_idx) dimension; broadcast only after a size check."""
    d = dim.select(F.col("label").alias("__dim_label"), F.col("label_idx").alias("__dim_idx"))
    d = bounded_broadcast(d, max_broadcast_rows)
    joined = df.join(d, df[label_col] == d["__dim_label"], "left")
    return (joined.withColumn(out, F.coalesce(F.col("__dim_idx"), F.lit(UNKNOWN)))
            .drop("__dim_label", "__dim_idx"))


def quarantine_status(idx_col: str = "label_idx") -> Column:
    return F.when(F.col(idx_col) >= 0, F.lit("train")).otherwise(F.lit("quarantine"))
