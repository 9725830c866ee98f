"""The programs: ``python -m vigil.jobs {publish,ingest,compact,land,train,score} --config job.yaml``.

Each wires config -> session -> source -> job. A config holds the sections of
``EngineConfig`` and a section ``job`` (``JobConfig``); unknown keys are rejected. Stream
sources and sinks are Kafka (``stream.format: kafka``, any ``kafka.*`` option under
``stream.options``) or file streams.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, fields
from typing import Any, Mapping

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import EngineConfig
from vigil.functions import arrays as ar
from vigil.functions import text as tx
from vigil.functions.labels import encode_label
from vigil.operators import training as tr
from vigil.schemas import CLASS_NAMES
from vigil.session import build_session
from vigil.sinks.keyed_table import KeyedTable
from vigil.sources.manifest import read_manifest_files
from vigil.sources.stream import RECORD_SCHEMA, read_stream
from vigil.streaming import jobs
from vigil.streaming.producer import publish_manifest


@dataclass(frozen=True)
class JobConfig:
    """Places and choices of one run."""

    source: str | None = None  # manifest files, records of a file stream, or landed batches
    target: str | None = None  # topic folder, store, landing table, model or predictions
    checkpoint: str | None = None
    quarantine: str | None = None  # default: next to the target
    media: str | None = None  # media root (publish) or media table ``id, text`` (path strategy)
    strategy: str = "path"  # where features come from: "path" or "payload"
    model: str | None = None
    available_now: bool = True
    processing_time: str | None = None

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {sorted(STRATEGIES)}, got {self.strategy!r}")


def series_features(body: F.Column, length: int, zero: F.Column) -> list[F.Column]:
    """The fixed-length series of a text, zeros and a status where there is none."""
    series = ar.pad_truncate(F.transform(F.split(F.coalesce(body, F.lit("")), " "), lambda w: F.length(w)), length, "int")
    return [F.when(body.isNull(), F.array_repeat(F.lit(0), length)).otherwise(series).alias("series"),
            F.when(body.isNull(), zero).otherwise("ok").alias("status")]


def from_path(spark: SparkSession, cfg: EngineConfig, job: JobConfig) -> Callable[[DataFrame], DataFrame]:
    media = spark.read.parquet(_given(job.media, "media")).select(F.col("id").cast("string").alias("id"), F.col("text").alias("__body"))

    def featurize(good: DataFrame) -> DataFrame:
        return good.join(media, "id", "left").select("id", "url", "label", "text_embedding", "split",
                                                     *series_features(F.col("__body"), cfg.features.series_length, F.lit("missing")))
    return featurize


def from_payload(spark: SparkSession, cfg: EngineConfig, job: JobConfig) -> Callable[[DataFrame], DataFrame]:
    def featurize(good: DataFrame) -> DataFrame:
        status = tx.payload_status("video_encoded")
        body = F.when(status == "ok", tx.b64decode_guarded("video_encoded")).cast("string")
        return good.select("id", "url", "label", "text_embedding", "split", *series_features(body, cfg.features.series_length, status))
    return featurize


STRATEGIES = {"path": from_path, "payload": from_payload}


def _given(value: str | None, name: str) -> str:
    if not value:
        raise ValueError(f"this job needs job.{name}")
    return value


def publish(spark: SparkSession, cfg: EngineConfig, job: JobConfig) -> None:
    publish_manifest(spark, read_manifest_files(spark, _given(job.source, "source")), cfg.stream, job.target, job.media)


def ingest(spark: SparkSession, cfg: EngineConfig, job: JobConfig) -> jobs.StreamResult:
    records = read_stream(spark, cfg.stream, job.source, RECORD_SCHEMA)
    return jobs.ingest_to_store(records, _given(job.target, "target"), _given(job.checkpoint, "checkpoint"), STRATEGIES[job.strategy](spark, cfg, job),
                                cfg.stream.mode, quarantine=job.quarantine, available_now=job.available_now, by=("split",), buckets=cfg.shuffle_partitions)


def compact(spark: SparkSession, cfg: EngineConfig, job: JobConfig) -> None:
    """Fold the store's commits into one beside its readers (but for each run's newest batch). What older
    snapshots name stays on disk until ``KeyedTable.vacuum``."""
    KeyedTable.open(spark, _given(job.source, "source")).compact()


def land(spark: SparkSession, cfg: EngineConfig, job: JobConfig) -> jobs.StreamResult:
    records = read_stream(spark, cfg.stream, job.source, RECORD_SCHEMA)
    return jobs.land(records, _given(job.target, "target"), _given(job.checkpoint, "checkpoint"), STRATEGIES[job.strategy](spark, cfg, job),
                     cfg.stream.mode, quarantine=job.quarantine, available_now=job.available_now)


def _vectors(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    text = ar.pad_truncate(ar.default_vector("text_embedding", cfg.features.text_dim), cfg.features.text_dim, "float")
    return rows.withColumn("features", array_to_vector(F.concat(F.col("series").cast("array<double>"), text.cast("array<double>"))))


def train(spark: SparkSession, cfg: EngineConfig, job: JobConfig) -> str:
    """Fit on the rows of the feature store whose label is known; the best round is saved."""
    known = KeyedTable.open(spark, _given(job.source, "source")).current(F.col("split").isin("train", "val"))  # prunes the other splits' files
    rows = known.withColumn("label", encode_label(F.col("label")).cast("double")).where("label >= 0")
    rows = _vectors(rows, cfg).select("features", "label", "split")
    result = tr.train_early_stop(rows.where("split = 'train'"), rows.where("split = 'val'"), len(CLASS_NAMES), cfg.train)
    return tr.save_model(result.model, _given(job.target, "target"))


def score(spark: SparkSession, cfg: EngineConfig, job: JobConfig) -> jobs.StreamResult:
    """Score newly landed rows; the stream's checkpoint is the log of batches seen."""
    source, model = _given(job.source, "source"), tr.load_model(_given(job.model, "model"))
    landed = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    return jobs.score_landed(landed.drop("run_id", "batch_id"), _given(job.target, "target"), _given(job.checkpoint, "checkpoint"),
                             lambda batch: tr.score(model, _vectors(batch, cfg), CLASS_NAMES, ["id", "url"]), job.available_now, job.processing_time)


JOBS = {"publish": publish, "ingest": ingest, "compact": compact, "land": land, "train": train, "score": score}


def run(name: str, raw: Mapping[str, Any], spark: SparkSession | None = None):
    """Run one job from a parsed config."""
    raw = dict(raw)
    given = dict(raw.pop("job", {}))
    unknown = set(given) - {f.name for f in fields(JobConfig)}
    if unknown:
        raise ValueError(f"unknown keys in job: {sorted(unknown)}")
    cfg, job = EngineConfig.from_dict(raw), JobConfig(**given)
    return JOBS[name](spark or build_session(f"vigil-{name}", shuffle_partitions=cfg.shuffle_partitions), cfg, job)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--config", required=True)
    args = parser.parse_args()
    import yaml

    with open(args.config) as f:
        run(args.job, yaml.safe_load(f) or {})


if __name__ == "__main__":
    main()
