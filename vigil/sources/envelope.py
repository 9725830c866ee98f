"""Message envelope decode with a quarantine (OP-13, OP-14, OP-15, OP-16).

One decode for batch and stream: ``CAST(value AS STRING)`` -> ``from_json`` with the
envelope schema of the mode -> flatten, ``idx`` renamed to the key ``id``. Records
whose key is null (malformed JSON, missing field, another producer's schema) are
routed to a quarantine frame instead of reaching the keyed table with a null key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.schemas import envelope_schema

CORRUPT = "_corrupt_record"


def decode(df: DataFrame, mode: str = "training", value_col: str = "value",
           keep: list[str] | None = None) -> DataFrame:
    """Decode envelopes; adds ``status`` (good|quarantine) and ``reason``.

    ``keep`` carries source columns through (e.g. Kafka ``key``, ``offset``).
    """
    schema = envelope_schema(mode)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    keep = keep or []
    parsed = df.select(
        *keep,
        F.from_json(F.col(value_col).cast("string"), with_corrupt,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("__env"))
    fields = [F.col(f"__env.{f.name}").alias("id" if f.name == "idx" else f.name) for f in schema.fields]
    corrupt = F.col(f"__env.{CORRUPT}")
    out = parsed.select(*keep, *fields, corrupt.alias("__corrupt"))
    reason = (F.when(F.col("id").isNotNull() & F.col("__corrupt").isNotNull(), F.lit("type_mismatch"))
              .when(F.col("id").isNotNull(), F.lit(None).cast("string"))
              .when(F.col("__corrupt").isNotNull(), F.lit("malformed"))
              .otherwise(F.lit("missing_id")))
    return (out.withColumn("status", F.when(F.col("id").isNotNull(), "good").otherwise("quarantine"))
            .withColumn("reason", reason)
            .drop("__corrupt"))


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = decoded.where(F.col("status") == "good")
    bad = decoded.where(F.col("status") == "quarantine")
    return good, bad
