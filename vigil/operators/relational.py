"""Models as tables: fitted in closed form by one aggregate, scored by joins and sums (OP-65, OP-72, OP-76, OP-12).

A model is one table ``layer, input, output, w``: the layer ``bias`` has one row per class, the layer
``linear`` one per input place and class. Items are sparse rows ``key, input, value``, made in the
scan; a score is the sum of value times weight. The weights are bounded by places x classes, which
the caller states and ``score`` checks before it broadcasts them as one row a place with an array
over classes; sums are partial before the shuffle, so that an item costs one row per task, however
long it is. Everything is SQL-expressible and exact up to the order of sums.

* ``fit_naive_bayes``: multinomial, from one count per class and place;
* ``fit_centroids``: nearest class mean, from one mean per class and place.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.labels import decode_label, sensitive_flag
from vigil.functions.scoring import argmax, softmax
from vigil.functions.text import tokens
from vigil.session import materialize

MOST_WEIGHTS = 1 << 22  # places x classes that may be broadcast (32 MB)
_SCHEMA = "layer string, input int, output int, w double"


def token_bucket(token: Column, places: int) -> Column:
    """A token's place: its md5 (first 8 hex digits) modulo ``places``."""
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % places).cast("int")


def token_places(text: str, places: int) -> Column:
    """``token_bucket`` of each of the text's ``tokens``. A batch's distinct tokens are hashed once each."""
    @F.arrow_udf("array<int>")
    def at(lowered: pa.Array) -> pa.Array:
        words = pc.split_pattern(lowered, " ")
        coded = words.flatten().dictionary_encode()
        of = np.fromiter((int.from_bytes(hashlib.md5(w).digest()[:4], "big") % places for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.int32)
        return pa.ListArray.from_arrays(words.offsets, pa.array(of[coded.indices.to_numpy()], pa.int32()))
    return at(F.lower(F.coalesce(F.col(text), F.lit(""))))


def token_rows(docs: DataFrame, key: str, places: int, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, input, value`` (1 each) of each token; an item without tokens has one row without input."""
    buckets = F.transform(F.coalesce(tokens(text), F.array().cast("array<string>")), lambda w: token_bucket(w, places))
    return docs.select(key, *carry, F.explode_outer(buckets).alias("input"), F.lit(1.0).alias("value"))


def vector_rows(items: DataFrame, key: str, vector: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, input, value`` of each component."""
    rows = items.select(key, *carry, F.posexplode_outer(F.col(vector).cast("array<double>")).alias("input", "value"))
    return rows.withColumn("value", F.coalesce("value", F.lit(0.0)))


def _grid(spark: SparkSession, places: int, classes: int) -> DataFrame:
    """Every place and class."""
    return spark.range(places * classes).select((F.col("id") / classes).cast("int").alias("input"), (F.col("id") % classes).cast("int").alias("output"))


def fit_naive_bayes(rows: DataFrame, items: DataFrame, label: str, places: int, classes: int, smooth: float = 1.0) -> DataFrame:
    """``rows`` are token rows that carry ``label`` (0 to classes - 1), ``items`` one row per item with it."""
    spark = rows.sparkSession
    counts = rows.where("input is not null").groupBy("input", F.col(label).cast("int").alias("output")).agg(F.sum("value").alias("n"))
    counts = materialize(_grid(spark, places, classes).join(counts, ["input", "output"], "left").na.fill(0.0, ["n"]), "token_counts")
    totals = counts.groupBy("output").agg(F.sum("n").alias("total"))  # one row a class
    linear = counts.join(F.broadcast(totals), "output").select(
        F.lit("linear").alias("layer"), "input", "output", (F.log(F.col("n") + smooth) - F.log(F.col("total") + smooth * places)).alias("w"))
    seen = items.groupBy(F.col(label).cast("int").alias("output")).agg(F.count("*").alias("n"))
    prior = _grid(spark, 1, classes).join(F.broadcast(seen), "output", "left").na.fill(0, ["n"])
    all_ = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()[0]
    bias = prior.select(F.lit("bias").alias("layer"), "input", "output", F.log((F.col("n") + 1) / F.lit(float(all_ + classes))).alias("w"))
    return bias.unionByName(linear)


def fit_centroids(rows: DataFrame, label: str, places: int, classes: int) -> DataFrame:
    """Twice the class mean per place, less the mean's squared length: the largest score is the nearest mean."""
    means = rows.where("input is not null").groupBy("input", F.col(label).cast("int").alias("output")).agg(F.avg("value").alias("m"))
    means = materialize(means.where((F.col("output") >= 0) & (F.col("output") < classes) & (F.col("input") < places)), "means")
    lengths = means.groupBy("output").agg((-F.sum(F.col("m") * F.col("m"))).alias("w"))
    absent = F.coalesce("w", F.lit(-1e300))  # a class without rows is never the nearest
    bias = _grid(rows.sparkSession, 1, classes).join(F.broadcast(lengths), "output", "left").select(F.lit("bias").alias("layer"), "input", "output", absent.alias("w"))
    return bias.unionByName(means.select(F.lit("linear").alias("layer"), "input", "output", (F.col("m") * 2).alias("w")))


def save(weights: DataFrame, path: str) -> str:
    """Keep a model (OP-12): its rows as a table."""
    weights.write.mode("overwrite").parquet(path)
    return path


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def logits(rows: DataFrame, key: str, weights: DataFrame, classes: int) -> DataFrame:
    """``key, logits`` of each item (a row with a null key is an item of its own kind: they add up)."""
    n = weights.limit(MOST_WEIGHTS + 1).count()
    if n > MOST_WEIGHTS:
        raise ValueError(f"over {MOST_WEIGHTS} weights can't be broadcast")
    linear = weights.where("layer = 'linear'").groupBy("input").agg(F.map_from_entries(F.collect_list(F.struct("output", "w"))).alias("by"))
    linear = linear.select("input", *[F.coalesce(F.col("by")[c], F.lit(0.0)).alias(f"__w{c}") for c in range(classes)])
    bias = {r.output: r.w for r in weights.where("layer = 'bias'").collect()}  # one row a class
    sums = rows.join(F.broadcast(linear), "input", "left").groupBy(key).agg(
        *[F.coalesce(F.sum(F.col("value") * F.col(f"__w{c}")), F.lit(0.0)).alias(f"__s{c}") for c in range(classes)])
    return sums.select(key, F.array(*[F.col(f"__s{c}") + F.lit(float(bias.get(c, 0.0))) for c in range(classes)]).alias("logits"))


def predict(scored: DataFrame, key: str, names: list[str]) -> DataFrame:
    """``key, prediction, predicted_label, sensitive, confidence``; equal logits go to the smaller class."""
    label = decode_label("prediction", names)
    return (scored.withColumn("prediction", argmax("logits"))
            .select(key, "prediction", label.alias("predicted_label"), sensitive_flag(label).alias("sensitive"),
                    F.round(F.array_max(softmax("logits")), 6).alias("confidence")))
