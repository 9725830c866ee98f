"""SparkSession construction and the shared scratch folder.

Scratch output (landed batches, feature stores, checkpoints) always lives under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that is unset (unit
tests on a laptop) do we create one ourselves.
"""

from __future__ import annotations

import hashlib
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "vigil", master: str | None = None, shuffle_partitions: int = 200,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # whole texts / media payloads per row: keep Arrow batches to Python small
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
        # streaming state (dedupe keys) can grow large: keep it in RocksDB, off-heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if master and master.startswith("local"):
        conf["spark.driver.bindAddress"] = "127.0.0.1"
        conf["spark.driver.host"] = "127.0.0.1"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def package_zip(folder: str) -> str:
    """The package's modules as one archive in ``folder``; the same modules give the same name."""
    root = pathlib.Path(__file__).resolve().parent
    files = sorted(p for p in root.rglob("*.py"))
    digest = hashlib.sha256()
    for p in files:
        digest.update(str(p.relative_to(root)).encode() + b"\0" + p.read_bytes() + b"\0")
    path = pathlib.Path(folder) / f"{root.name}-{digest.hexdigest()[:16]}.zip"
    if not path.exists():
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for p in files:
                z.write(p, p.relative_to(root.parent))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, whose Python workers import it for extractors, towers and payloads. Spark
    copies the archive from the driver to every executor, also to those that come later. Not needed on a local
    master, or where the package is installed on every machine."""
    if not spark.sparkContext.master.startswith("local["):
        spark.sparkContext.addPyFile(package_zip(tempfile.mkdtemp(prefix="vigil-zip-")))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster. Where it is unset, a local one is made on a
    local master; elsewhere that is an error, since executors don't share local folders."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="vigil-ckpt-")  # one machine only: nothing configured
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/vigil/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Cut lineage by writing a table in the shared checkpoint folder and reading it back.

    Used where two passes must see identical data (range-partitioned numbering: the
    partition id and position are stored as columns) and where a recomputation after
    executor loss must not re-sample. Unlike an unpersisted ``checkpoint()``, the plan
    is computed once; the files live on shared storage, so losing an executor loses
    nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
