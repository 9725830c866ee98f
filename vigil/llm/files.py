"""Files that tasks write and read in the shared folder.

Spark has no writer for raw binary files, so tasks open them through ``pyarrow.fs``, by the URI
of the folder (local and mounted paths, hdfs, s3, gs). Each attempt of a task writes a name of
its own; only names that a finished task returned, kept in a written table, are ever read, so
retried, speculative and lost attempts leave nothing but unread files.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def fresh(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def write(uri: str, parts: list[bytes]) -> None:
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        for p in parts:
            out.write(p)
