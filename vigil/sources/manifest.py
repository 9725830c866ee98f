"""Split manifests: build, write and read (OP-02, OP-11).

A manifest document is one JSON object ``key -> {url, label[, text_embedding, flag]}``.
Building one document per split would funnel a whole split through one task, so
documents are built per (split, chunk) with a bounded number of entries each. For
large manifests the JSON-lines form (one entry per line, partitioned by split) is the
scalable layout and is what ``write_manifest`` produces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.schemas import MANIFEST, MANIFEST_ENTRY


def manifest_documents(df: DataFrame, key: str = "idx", split: str = "split",
                       chunk: str = "chunk") -> DataFrame:
    """``split, chunk, doc``: one map-of-struct JSON document per (split, chunk)."""
    entry = F.struct(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in MANIFEST_ENTRY.fields])
    return (df.groupBy(split, chunk)
            .agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), entry))).alias("__m"))
            .select(split, chunk, F.to_json("__m").alias("doc")))


def explode_documents(docs: DataFrame, doc: str = "doc", carry: list[str] | None = None) -> DataFrame:
    """Parse map-of-struct documents and explode to one row per entry."""
    carry = carry or []
    parsed = docs.select(*carry, F.explode(F.from_json(F.col(doc), MANIFEST)).alias("idx", "__e"))
    return parsed.select(*carry, "idx", "__e.url", "__e.label", "__e.text_embedding", "__e.flag")


def read_manifest_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole-file JSON manifests (the original layout): one task per file."""
    docs = spark.read.text(path, wholetext=True).withColumn("source_file", F.input_file_name())
    return explode_documents(docs.withColumnRenamed("value", "doc"), carry=["source_file"])


def write_manifest(df: DataFrame, dst: str, split: str = "split") -> DataFrame:
    """JSON-lines manifest partitioned by split; returns per-split counts."""
    df.write.mode("overwrite").partitionBy(split).json(dst)
    written = T.StructType([f for f in df.schema.fields if f.name != split])  # given, not inferred by a pass over the output
    return df.sparkSession.read.schema(written).json(dst).groupBy(split).agg(F.count(F.lit(1)).alias("n_items"))


def read_manifest_lines(spark: SparkSession, path: str) -> DataFrame:
    schema = "idx string, url string, label string, text_embedding array<float>, flag string"
    return spark.read.schema(schema).json(path)
