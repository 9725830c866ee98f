"""Connected components of an edge table by alternating star contractions.

Each round is two joins with a grouped minimum (partial aggregation before the shuffle; a
hub's rows are split by the adaptive skew join) and is written to the shared folder, so
lineage is cut and a lost executor costs a task. Nothing is collected but a row of counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large: each node's larger neighbours point at the smallest of its neighbourhood;
    small: the node and its smaller neighbours do."""
    if large:
        both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    else:
        both = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
    met = both.join(least, "src")
    if large:
        out = met.where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    else:
        out = met.select(F.col("dst").alias("src"), F.col("m").alias("dst")).union(
            least.select("src", F.col("m").alias("dst")))
    return out.where("src != dst").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (the smallest node reachable) of each node of ``edges``.

    ``edges`` has ``src`` and ``dst`` (long); order, repeats and loops don't matter. Nodes
    without an edge to another node are left out. An empty table gives an empty one.
    """
    now = materialize(edges.select("src", "dst").where("src != dst").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        now = materialize(_stars(_stars(now, True), False), "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("component")).union(
        now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
