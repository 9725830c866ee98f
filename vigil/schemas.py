"""Envelope schemas and the label dimension.

The label dimension is the single source of truth for class indexes: training,
scoring and reporting all join against it (the training and scoring maps of the
original disagree; here there is only one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values (must equal the original application's) -------------------------
# Class names in canonical alphabetical order; the index is the position.
CLASS_NAMES = ["horrible", "normal", "offensive", "pornographic", "superstitious", "violent"]
# Every class except "normal" is sensitive.
SENSITIVE_CLASSES = ["horrible", "offensive", "pornographic", "superstitious", "violent"]
# Media file extensions recognised by the directory scan (compared lower-case).
MEDIA_EXTENSIONS = [".mp4", ".avi", ".mov", ".mkv"]

FLOAT_ARRAY = T.ArrayType(T.FloatType())

# Training flavour of the message envelope.
TRAINING_ENVELOPE = T.StructType([
    T.StructField("idx", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("text_embedding", FLOAT_ARRAY),
    T.StructField("split", T.StringType()),
])

# Inference flavour: adds the base64 media payload.
INFERENCE_ENVELOPE = T.StructType([
    T.StructField("idx", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("video_encoded", T.StringType()),
    T.StructField("text_embedding", FLOAT_ARRAY),
    T.StructField("split", T.StringType()),
])

# -----------------------------------------------------------------------------------

ENVELOPES = {"training": TRAINING_ENVELOPE, "inference": INFERENCE_ENVELOPE}

# Manifest: one JSON object per split, key -> {url, label[, text_embedding, flag]}.
MANIFEST_ENTRY = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("text_embedding", FLOAT_ARRAY),
    T.StructField("flag", T.StringType()),
])
MANIFEST = T.MapType(T.StringType(), MANIFEST_ENTRY)


def envelope_schema(mode: str) -> T.StructType:
    try:
        return ENVELOPES[mode]
    except KeyError:
        raise ValueError(f"unknown envelope mode {mode!r}; expected one of {sorted(ENVELOPES)}")


def label_dimension(spark: SparkSession, names: list[str] | None = None,
                    sensitive: list[str] | None = None) -> DataFrame:
    """Tiny dimension table ``label, label_idx, sensitive``; its size is the class count."""
    names = CLASS_NAMES if names is None else names
    sens = set(SENSITIVE_CLASSES if sensitive is None else sensitive)
    rows = [(n, i, n in sens) for i, n in enumerate(names)]
    schema = "label string, label_idx int, sensitive boolean"
    return spark.createDataFrame(rows, schema)
