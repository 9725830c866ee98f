"""Message stream source (OP-01, OP-55, OP-63).

Kafka when its connector exists; otherwise a file stream of the same ``key, value``
records. Back-pressure (records or files per trigger), start position and data-loss
policy come from the validated config.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.config import StreamConfig

RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])


KAFKA_PROVIDER = "org.apache.spark.sql.kafka010.KafkaSourceProvider"


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(KAFKA_PROVIDER)
        return True
    except Exception:
        return False


def require_kafka(spark: SparkSession) -> None:
    if not kafka_available(spark):
        raise RuntimeError("the Kafka source/sink needs the spark-sql-kafka connector on the classpath "
                           "(spark.jars.packages); use a file stream (StreamConfig(format='parquet')) otherwise")


def read_stream(spark: SparkSession, cfg: StreamConfig, path: str | None = None,
                schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    if cfg.format == "kafka":
        require_kafka(spark)
        reader = (spark.readStream.format("kafka").options(**cfg.options)
                  .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
                  .option("subscribe", cfg.topic)
                  .option("startingOffsets", cfg.starting_offsets)
                  .option("failOnDataLoss", str(cfg.fail_on_data_loss).lower()))
        if cfg.max_offsets_per_trigger is not None:
            reader = reader.option("maxOffsetsPerTrigger", str(cfg.max_offsets_per_trigger))
        return reader.load()
    if not path:
        raise ValueError("a file stream needs a path")
    # start position for file streams: "earliest" replays the oldest files first,
    # "latest" processes the newest first (the file source's latestFirst)
    reader = (spark.readStream.format(cfg.format).schema(schema)
              .option("latestFirst", str(cfg.starting_offsets == "latest").lower()))
    if cfg.max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(cfg.max_files_per_trigger))
    # where a record stands in the topic's files: what orders records of one key
    return reader.load(path).select("*", F.col("_metadata.file_modification_time").alias("timestamp"),
                                    F.col("_metadata.file_path").alias("source_file"))
