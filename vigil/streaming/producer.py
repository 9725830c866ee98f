"""Manifest -> message records -> topic: the producer side as one distributed job
(OP-02, OP-07, OP-08, OP-31).

Every executor encodes and sends its own rows (the original sent one record per
second from a single process). Records get a stable id ``sha256(split:url)`` so a
re-publish is deduplicated downstream instead of creating new items; in inference
mode the media payload is attached as base64, with a status for missing files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import StreamConfig
from vigil.functions.text import stable_id
from vigil.sinks.envelope import encode, publish
from vigil.sources.files import load_payloads


def manifest_to_records(spark: SparkSession, manifest: DataFrame, mode: str = "training",
                        media_root: str | None = None) -> DataFrame:
    """``key, value, payload_status`` records from manifest rows
    (``url, label[, text_embedding], split | flag``)."""
    items = manifest
    if "split" not in items.columns:
        items = items.withColumn("split", F.col("flag"))
    items = items.withColumn("id", stable_id("split", "url"))
    if mode == "inference":
        if not media_root:
            raise ValueError("inference records need the media root to attach payloads")
        items = load_payloads(spark, items, media_root).withColumnRenamed("payload", "video_encoded")
    else:
        items = items.withColumn("payload_status", F.lit(None).cast("string"))
    return encode(items, mode, key_col="id", carry=("payload_status",))


def publish_manifest(spark: SparkSession, manifest: DataFrame, cfg: StreamConfig, path: str | None = None,
                     media_root: str | None = None) -> None:
    """Encode and publish every manifest entry (records with a missing payload are still
    sent, with a null payload, and are quarantined by the feature job)."""
    records = manifest_to_records(spark, manifest, cfg.mode, media_root)
    publish(records.select("key", "value"), cfg, path)
