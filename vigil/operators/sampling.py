"""Uniform sampling of k items from ordered sequences, with zero padding (OP-53).

Semantics of the original frame sampler, per sequence of n items at positions 0..n-1:
``interval = max(n div k, 1)``; candidate positions are 0, interval, 2*interval, ...
(< n) in order; unreadable candidates are skipped without using quota; the first k
readable candidates are kept; the result is padded to k with empty slots. The tail
beyond k*interval is ignored (n=59, k=30 keeps 0..29).

Plan: sequence length by a partially aggregated ``count`` (skew-proof), joined back
(AQE splits a hot sequence), then the position filter. Only candidates (at most about
2k per sequence) are shuffled for the per-sequence rank, so no window ever holds a
whole long sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def uniform_sample(items: DataFrame, key: str, pos: str, k: int, readable: str | None = None,
                   keys: DataFrame | None = None, slot: str = "slot") -> DataFrame:
    """Return ``key, slot (0..k-1), <item columns or null for padding>, is_pad``.

    ``pos`` must be the 0-based position of the item in its sequence. ``keys`` lists
    sequences that must appear even when they have no items at all (all padding);
    by default every sequence with at least one item appears.
    """
    items = items.where(F.col(key).isNotNull())  # identical subplans -> the length exchange is reused
    lengths = items.groupBy(key).agg(F.count(F.lit(1)).alias("__us_n"))
    interval = F.greatest(F.floor(F.col("__us_n") / F.lit(k)), F.lit(1)).cast("long")
    cand = (items.join(lengths, key, "inner")
            .where((F.col(pos) % interval) == 0))
    if readable is not None:
        cand = cand.where(F.col(readable))
    w = Window.partitionBy(key).orderBy(pos)
    kept = (cand.withColumn("__us_rank", F.row_number().over(w))
            .where(F.col("__us_rank") <= k)
            .withColumn(slot, (F.col("__us_rank") - 1).cast("int"))
            .drop("__us_rank", "__us_n")
            .withColumn("is_pad", F.lit(False)))

    counts = kept.groupBy(key).agg(F.count(F.lit(1)).alias("__us_kept"))
    # every sequence seen (from the length aggregate, or the given key list) gets padded,
    # including one whose candidates were all unreadable
    known = lengths.select(key) if keys is None else keys.select(key).distinct()
    counts = (known.join(counts, key, "left")
              .withColumn("__us_kept", F.coalesce("__us_kept", F.lit(0))))
    pads = (counts.where(F.col("__us_kept") < k)
            .select(key, F.explode(F.sequence(F.col("__us_kept").cast("int"), F.lit(k - 1))).alias(slot))
            .withColumn("is_pad", F.lit(True)))
    return kept.unionByName(pads, allowMissingColumns=True)
