"""Media directory scan, class-per-directory index, payload load (OP-03, OP-06, OP-07).

The directory scan reads only ``path`` and ``length`` of the binaryFile source, so
file contents are never read for a listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.text import b64encode, file_ext, parent_dir, path_segment
from vigil.operators.joins import bounded_broadcast
from vigil.operators.ranking import dense_index
from vigil.schemas import MEDIA_EXTENSIONS
from vigil.sources.payloads import with_payloads


def scan_media(spark: SparkSession, root: str, extensions: list[str] = MEDIA_EXTENSIONS) -> DataFrame:
    """``path, length, ext``: recursive listing, extension matched case-insensitively."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select("path", "length"))
    exts = [e.lower() for e in extensions]
    return files.withColumn("ext", file_ext("path")).where(F.col("ext").isin(*exts))


def class_index(files: DataFrame, path_col: str = "path", max_classes: int = 100_000) -> DataFrame:
    """Label = parent directory name; index = rank of the label among sorted labels."""
    labelled = files.withColumn("label", path_segment(parent_dir(path_col), -1))
    index = bounded_broadcast(dense_index(labelled, "label", out="class_idx"), max_classes)
    return labelled.join(index, "label", "left")


def load_payloads(spark: SparkSession, wanted: DataFrame, root: str, url_col: str = "url") -> DataFrame:
    """Attach ``payload`` (base64 text), ``payload_status`` (ok, empty, missing, unreadable) and ``payload_error`` to each
    wanted row. Only wanted files are opened; a path outside of ``root`` is missing."""
    loaded = with_payloads(spark, wanted, url_col, under=root)
    return loaded.withColumn("payload", b64encode("content")).drop("content")
