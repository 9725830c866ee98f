"""Join helper: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (metadata only, no job); None if unknown."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return None


def provably_at_most(df: DataFrame, max_rows: int, max_bytes: int | None = 1 << 30) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. An input whose estimated size
    is over ``max_bytes`` is treated as large without running anything; otherwise a
    bounded count decides (it stops after ``max_rows + 1`` rows). Pass
    ``max_bytes=None`` for aggregates that are small by construction: without
    column statistics their estimate is their input's size."""
    size = estimated_bytes(df) if max_bytes is not None else None
    if size is not None and size > max_bytes:
        return False
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(small: DataFrame, max_rows: int, use_estimate: bool = True) -> DataFrame:
    """Broadcast hint only if ``small`` provably has at most ``max_rows`` rows.

    The check first consults the size estimate (a large input is never counted), then
    a bounded count (``limit(max_rows + 1)``). Beyond the bound the frame is returned
    unhinted and the planner (with AQE) picks a shuffle join.
    """
    ok = provably_at_most(small, max_rows, max_bytes=(1 << 30) if use_estimate else None)
    return F.broadcast(small) if ok else small


FILTER_BITS = 1 << 26  # 8 MB


def with_ids(rows: DataFrame, ids: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose ``id`` is among ``ids`` (column ``id``), without moving the others.

    A bitmap of the ids' hashes, of so many ``bits`` whatever their number, goes to all tasks;
    what passes it (all wanted rows, few others) is then joined exactly.
    """
    def place(df: DataFrame) -> DataFrame:
        h = F.pmod(F.xxhash64("id"), F.lit(bits))
        return df.withColumn("bucket", F.bitmap_bucket_number(h)).withColumn("place", F.bitmap_bit_position(h))

    bitmaps = place(ids.where("id is not null")).groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", (F.col("place") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    is_set = F.expr("shiftright(b, cast(place % 8 as int)) % 2 = 1")
    near = place(rows).join(F.broadcast(bitmaps), "bucket").withColumn("b", byte).where(is_set).select(*rows.columns)
    return near.join(ids.distinct(), "id").select(*rows.columns)  # a semi-join would be moved before the filter
