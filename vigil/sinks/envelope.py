"""Envelope encode and publish (OP-08).

A distributed write: every executor encodes and sends its own rows. The Kafka format
is used when its connector is on the classpath; a file sink with the same
``key, value`` binary columns stands in for it elsewhere (and in tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.config import StreamConfig
from vigil.schemas import envelope_schema
from vigil.sinks.chunks import split_messages


def encode(df: DataFrame, mode: str = "training", key_col: str = "id", carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, value`` binary columns; the envelope fields come from same-named columns
    (``idx`` from ``key_col``); absent optional fields are written as null. ``carry``
    passes extra columns through (e.g. a file-piece number)."""
    schema = envelope_schema(mode)
    parts = []
    for f in schema.fields:
        if f.name == "idx":
            parts.append(F.col(key_col).cast("string").alias("idx"))
        elif f.name in df.columns:
            parts.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            parts.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(F.col(key_col).cast("string").cast("binary").alias("key"),
                     F.to_json(F.struct(*parts)).cast("binary").alias("value"), *carry)


def publish(records: DataFrame, cfg: StreamConfig, path: str | None = None, undeliverable: str | None = None) -> None:
    """Write ``key, value`` records to the topic (or to ``path`` for file streams). With ``cfg.max_request_size``,
    longer messages go out in parts, and what can't be sent is written whole to ``undeliverable`` with its reason."""
    if cfg.max_request_size is not None:
        if not undeliverable:
            raise ValueError("a size limit needs a place for what can't be sent")
        records, refused = split_messages(records, cfg.max_request_size)
        refused.write.mode("append").parquet(undeliverable)
    if cfg.format == "kafka":
        from vigil.sources.stream import require_kafka

        require_kafka(records.sparkSession)
        (records.write.format("kafka").options(**{"kafka.acks": "all", **cfg.options})
         .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
         .option("topic", cfg.topic)
         .save())
    else:
        if not path:
            raise ValueError("file publishing needs a path")
        records.write.mode("append").format(cfg.format).save(path)
