"""Messages beyond the size limit of a topic, sent in parts (OP-08).

A record whose key and value fit in ``max_bytes`` goes out as it is. A longer value is cut into parts, each a record
of the same key (so of the same partition, in order) whose value is a header and a slice of bytes:

    mark (4 bytes) | MD5 of the whole value (16) | part number (4) | number of parts (4) | slice

A value that happens to start with the mark is sent as one part, so a reader never takes it for something else.
A null value (a tombstone) passes. Records that can't be sent come back apart, whole, with their reason:
``too_large`` (beyond ``max_message_bytes``) or ``key_too_long`` (no room for a slice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------------------
MARK = b"VGL1"
HEADER = 28
# --------------------------------------------------------------------------------------


def _four_bytes(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0"))


def _number(value: Column, start: int) -> Column:
    return F.conv(F.hex(F.substring(value, start, 4)), 16, 10).cast("int")


def is_part(value: Column) -> Column:
    return F.coalesce((F.substring(value, 1, len(MARK)) == F.lit(MARK)) & (F.octet_length(value) >= HEADER), F.lit(False))


def split_messages(records: DataFrame, max_bytes: int, max_message_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(sendable, rejected)``: records of at most ``max_bytes`` (key and value), and the records that can't be sent,
    with a ``reason``. ``records`` has binary columns ``key, value``; others are carried."""
    if max_bytes <= HEADER:
        raise ValueError(f"max_bytes must exceed the header of {HEADER} bytes")
    key, value = F.col("key"), F.col("value")
    length = F.octet_length(value)
    key_length = F.coalesce(F.octet_length(key), F.lit(0))
    room = F.lit(max_bytes - HEADER) - key_length
    whole = value.isNull() | ((key_length + length <= max_bytes) & ~F.startswith(value, F.lit(MARK)))
    reason = F.when(length > max_message_bytes, "too_large") if max_message_bytes is not None else F.lit(None).cast("string")
    reason = F.coalesce(reason, F.when(key_length >= max_bytes, "key_too_long").when(~whole & (room < 1), "key_too_long"))
    judged = records.withColumn("reason", reason)
    rejected = judged.where(F.col("reason").isNotNull())
    carried = [c for c in records.columns if c not in ("key", "value")]

    def one(i: Column) -> Column:
        head = F.concat(F.lit(MARK), F.unhex(F.md5(value)), _four_bytes(i), _four_bytes(parts))
        return F.concat(head, F.substring(value, i * room + 1, room))
    parts = F.greatest(F.ceil(length / room), F.lit(1)).cast("int")
    values = F.when(whole, F.array(value)).otherwise(F.transform(F.sequence(F.lit(0), parts - 1), one))
    sendable = judged.where(F.col("reason").isNull()).select("key", F.explode(values).alias("value"), *carried)
    return sendable.select(*records.columns), rejected


def parsed(records: DataFrame) -> DataFrame:
    """``message`` (null for a whole record), ``part``, ``parts`` and ``body`` of each record, besides its columns."""
    value = F.col("value")
    part = is_part(value)
    return (records.withColumn("message", F.when(part, F.lower(F.hex(F.substring(value, 5, 16)))))
            .withColumn("part", F.when(part, _number(value, 21))).withColumn("parts", F.when(part, _number(value, 25)))
            .withColumn("body", F.when(part, F.substring(value, F.lit(HEADER + 1), F.octet_length(value)))))
