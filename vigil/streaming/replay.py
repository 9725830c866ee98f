"""Backfill a stored table through the stream path in paced pieces (OP-64).

The table is cut into ``buckets`` ordered pieces, one file each, written in order so
that a file source with ``maxFilesPerTrigger`` replays them piece by piece (the
original sent one record per second; here the pace is a source option).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.joins import estimated_bytes


FILE_BYTES = 64 << 20


def files_for(df: DataFrame, pieces: int = 1) -> int:
    """Files per piece so that each holds about ``FILE_BYTES`` of the optimizer's estimate."""
    size = estimated_bytes(df)
    return max(1, -(-(size or 0) // (pieces * FILE_BYTES)))


def write_pieces(df: DataFrame, path: str, bucket: str, fmt: str = "parquet", files_per_piece: int | None = None,
                 salt_cols: list[str] | None = None, pieces: int = 1) -> int:
    """Write each bucket value under ``path/<bucket>=<v>/`` in a single job. Returns the files of a piece: with so many a
    trigger there are as many triggers as pieces, however large the table.

    A piece is split into ``files_per_piece`` files (by default as many as the input's size
    asks for, spread over ``pieces`` pieces), each written by a task of its own, by a
    deterministic hash salt over ``salt_cols`` (stable under task retry, unlike a random salt).
    """
    if files_per_piece is None:
        files_per_piece = files_for(df, pieces)
    if files_per_piece > 1:
        cols = salt_cols or [c for c in df.columns if c != bucket]
        salt = F.pmod(F.xxhash64(*cols), F.lit(files_per_piece))
        df = df.repartition(bucket, salt)
    else:
        df = df.repartition(bucket)
    df.write.mode("append").format(fmt).partitionBy(bucket).save(path)
    return files_per_piece


def write_ordered(df: DataFrame, path: str, bucket: str, values: list[int], fmt: str = "parquet",
                  replay_previous: bool = False, files_per_piece: int | None = None) -> int:
    """Write bucket files in order (file modification time = replay order), one job per
    bucket. With ``replay_previous`` every piece also re-sends the previous bucket
    (duplicates). A large piece is written by ``files_per_piece`` tasks (round-robin,
    deterministic under retry). Returns that number, which ``maxFilesPerTrigger`` must match."""
    if files_per_piece is None:
        files_per_piece = files_for(df, len(values))
    prev = None
    for v in values:
        part = df.where(F.col(bucket) == v)
        if replay_previous and prev is not None:
            part = part.unionByName(df.where(F.col(bucket) == prev))
        part = part.repartition(files_per_piece)
        part.write.mode("append").format(fmt).save(f"{path}/piece={v:06d}")
        prev = v
    return files_per_piece
