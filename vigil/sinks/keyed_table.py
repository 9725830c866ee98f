"""Transactional keyed table: upserts as commits, snapshots by one atomic file, merge on read (OP-09, OP-04).

    <path>/_table.json            key, schema, buckets, further partition columns
    <path>/_log/<version>.json    the commits that are live as of a version, oldest first
    <path>/data/commit=<id>/...   rows of a commit, dealt to buckets and sorted by key
    <path>/files/<id>, blooms/<id>   per data file: key range, rows, bucket; a Bloom filter over its keys

A commit writes data and its file statistics first; it becomes visible when the next log file is
created, which only one writer can do, and a loser tries again on top of the winner. Whatever a lost
driver leaves behind has no log entry and is never read. A batch ``(run_id, batch_id)`` that is sent again replaces its
earlier commit as a whole, also with fewer rows or none.

Rows are read through a bucketed catalog table, so the merge (per key the row of the latest
``(run_id, batch_id)``) needs no exchange, nor does a join of two tables with the same buckets.
``lookup`` opens only files whose bucket, key range and Bloom filter allow a wanted key. ``compact`` rewrites the
view as one commit beside readers, who keep their snapshot; the newest batch of each run stays
apart, since that is the one a restarted stream sends again. ``vacuum`` deletes what no kept snapshot names.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil import storage
from vigil.operators.joins import estimated_bytes
from vigil.operators.upsert import current_view

VERSION = ("run_id", "batch_id")
BITS_PER_KEY, HASHES, BITMAP_BITS = 10, 4, 32768  # the last is fixed by Spark's bitmap functions
WAIT_S, WAITS = 0.1, 100  # for a log file that another writer has created and not yet filled


@dataclass(frozen=True)
class Commit:
    id: str
    run_id: int  # -1: a compaction
    batch_id: int
    rows: int


class KeyedTable:
    """The table in ``path``; made by ``create`` or ``open``."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType, buckets: int, by: tuple[str, ...]):
        self.spark, self.path, self.key, self.schema, self.buckets, self.by = spark, path.rstrip("/"), key, schema, buckets, by
        self.name = f"keyed_{hashlib.md5(self.path.encode()).hexdigest()}"  # the catalog's name, of this session only
        self._known: set[str] = set()
        columns = [*(f for f in schema.fields if f.name not in by), *(T.StructField(c, T.LongType()) for c in VERSION)]
        self._ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns], [f"`{c}` {schema[c].dataType.simpleString()}" for c in by]
        self.columns = [*(f.name for f in columns), "commit", *by]
        if not spark.catalog.tableExists(self.name):
            self._declare(self.name, "data", True)

    def _declare(self, name: str, folder: str, commits: bool) -> None:
        """Tell the catalog of a bucketed folder: of all commits, or of one."""
        plain, by = self._ddl
        by = ["commit string", *by] if commits else by
        parts = f"PARTITIONED BY ({', '.join(c.split(' ')[0] for c in by)}) " if by else ""
        self.spark.sql(f"CREATE TABLE {name} ({', '.join(plain + by)}) USING parquet {parts}CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{folder}'")

    @classmethod
    def create(cls, spark: SparkSession, path: str, key: str, schema: T.StructType, buckets: int | None = None, by: tuple[str, ...] = ()) -> KeyedTable:
        """A new, empty table. ``by``: columns whose values a key never changes; scans prune by them."""
        clash = {"commit", *VERSION} & {f.name.lower() for f in schema.fields}
        if clash or key in by or key not in schema.names:
            raise ValueError(f"key {key!r} must be a column and no partition column; the table keeps the names {sorted(clash) or ['commit', *VERSION]}")
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        said = {"key": key, "schema": schema.jsonValue(), "buckets": buckets, "by": list(by)}
        if not storage.create_exclusive(spark, f"{path.rstrip('/')}/_table.json", json.dumps(said)):
            raise FileExistsError(f"there is a table in {path}")
        return cls(spark, path, key, schema, buckets, tuple(by))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        said = storage.read_text(spark, f"{path.rstrip('/')}/_table.json")
        if said is None:
            raise FileNotFoundError(f"no keyed table in {path}")
        d = json.loads(said)
        return cls(spark, path, d["key"], T.StructType.fromJson(d["schema"]), d["buckets"], tuple(d["by"]))

    @classmethod
    def open_or_create(cls, spark: SparkSession, path: str, key: str, schema: T.StructType, **more) -> KeyedTable:
        try:
            return cls.open(spark, path)
        except FileNotFoundError:
            return cls.create(spark, path, key, schema, **more)

    # --- the log -------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in storage.names(self.spark, f"{self.path}/_log") if n.endswith(".json"))

    def _read_log(self, version: int) -> list[Commit] | None:
        """None while its writer has not finished it."""
        said = storage.read_text(self.spark, f"{self.path}/_log/{version:012d}.json")
        try:
            return [Commit(**c) for c in json.loads(said or "")["commits"]]
        except (ValueError, KeyError):
            return None

    def snapshot(self, version: int | None = None) -> tuple[int, list[Commit]]:
        """A version (default: the last whole one) and its commits; version 0 is the empty table."""
        for v in [version] if version is not None else reversed(self.versions()):
            commits = self._read_log(v) if v else []
            if commits is not None:
                return v, commits
        if version is not None:
            raise ValueError(f"no version {version} of {self.path}")
        return 0, []

    def _commit(self, change) -> int:
        """Create the log file after the last; ``change`` maps live commits to the new ones."""
        waited = 0
        while True:
            version, live = self.snapshot()
            unfinished = [v for v in self.versions() if v > version]
            if unfinished and waited < WAITS:  # its writer may be at work, or lost
                waited += 1
                time.sleep(WAIT_S)
                continue
            following = max([version, *unfinished]) + 1
            text = json.dumps({"version": following, "commits": [asdict(c) for c in change(live)]})
            if storage.create_exclusive(self.spark, f"{self.path}/_log/{following:012d}.json", text):
                return following

    # --- writing -------------------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        """Rows (with version columns) as files of a new commit, and their statistics. Each commit is
        written under a root of its own, so that writers don't meet in the committer's folders."""
        commit = uuid.uuid4().hex
        name = f"{self.name}_{commit}"
        self._declare(name, f"data/commit={commit}", False)
        rows.select(*(c for c in self.columns if c != "commit")).repartition(self.buckets, self.key).write.insertInto(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
        return commit, self._describe(commit)

    def _describe(self, commit: str) -> int:
        try:
            data = self.spark.read.parquet(f"{self.path}/data/commit={commit}")
        except PySparkException:  # a commit without rows has no files
            return 0
        rows = data.select(F.col(self.key).alias("key"), F.col("_metadata.file_path").alias("file"))
        files = rows.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"),
                                         F.max(self._bucket(F.col("key"))).alias("bucket"), F.max(F.col("key").isNull()).alias("has_null"))
        most, total = files.agg(F.max("n"), F.sum("n")).first()
        bits = BITMAP_BITS
        while bits < (most or 0) * BITS_PER_KEY:
            bits *= 2
        files.withColumn("bits", F.lit(bits).cast("long")).coalesce(1).write.parquet(f"{self.path}/files/{commit}")
        blooms = rows.select("file", F.explode(self._places(F.col("key"), F.lit(bits))).alias("at")).groupBy(
            "file", F.bitmap_bucket_number("at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
        blooms.write.parquet(f"{self.path}/blooms/{commit}")
        return total or 0

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))  # the rule of bucketed tables

    @staticmethod
    def _places(key: Column, bits: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), bits) for i in range(HASHES)])

    def upsert(self, rows: DataFrame, run_id: int, batch_id: int) -> int:
        """Commit a batch (one row per key); the same batch again replaces what it wrote before. Returns the version."""
        folded = [c for c in self.snapshot()[1] if c.run_id == -1 and (run_id, batch_id) in self._folded(c)]
        if folded:
            raise ValueError(f"batch {batch_id} of run {run_id} has been compacted and can't be replaced")
        versioned = rows.withColumn("run_id", F.lit(int(run_id)).cast("long")).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        commit, n = self._write(versioned)
        return self._commit(lambda live: [c for c in live if (c.run_id, c.batch_id) != (run_id, batch_id)] + [Commit(commit, run_id, batch_id, n)])

    # --- reading -------------------------------------------------------------------------------

    def _rows(self, commits: list[Commit]) -> DataFrame:
        ids = [c.id for c in commits if c.rows]
        if not self._known.issuperset(ids):  # of other writers
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
            self._known.update(ids)
        return self.spark.table(self.name).where(F.col("commit").isin(ids))

    def current(self, only: Column | None = None, version: int | None = None) -> DataFrame:
        """Per key the row of the latest batch, with its ``run_id`` and ``batch_id``. ``only`` is a
        condition on the key or on ``by`` columns and reaches the scan."""
        rows = self._rows(self.snapshot(version)[1])
        return self._merged(rows if only is None else rows.where(only))

    def _merged(self, rows: DataFrame) -> DataFrame:
        return current_view(rows.drop("commit"), self.key).select(*self.schema.names, *VERSION)

    def files_for(self, keys: DataFrame, version: int | None = None) -> list[str]:
        """The data files that may hold one of ``keys`` (its column of the table's key)."""
        ids = [c.id for c in self.snapshot(version)[1] if c.rows]
        if not ids:
            return []
        files = self.spark.read.parquet(*[f"{self.path}/files/{i}" for i in ids])
        blooms = self.spark.read.parquet(*[f"{self.path}/blooms/{i}" for i in ids])
        wanted = keys.select(F.col(self.key).alias("key")).distinct().withColumn("bucket", self._bucket(F.col("key")))
        near = wanted.join(files, "bucket").where(F.when(F.col("key").isNull(), F.col("has_null")).otherwise(F.col("key").between(F.col("low"), F.col("high"))))
        places = near.select("file", "key", F.explode(self._places(F.col("key"), F.col("bits"))).alias("at"))
        places = places.select("file", "key", F.bitmap_bucket_number("at").alias("part"), F.bitmap_bit_position("at").alias("bit"))
        byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("bit") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        is_set = F.col("byte").bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
        hits = places.join(blooms, ["file", "part"]).withColumn("byte", byte).where(is_set)
        found = hits.groupBy("file", "key").agg(F.count("*").alias("n")).where(F.col("n") == HASHES)
        return sorted(r.file for r in found.select("file").distinct().collect())  # names of files

    def lookup(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The current rows of ``keys``, from the files that may hold them."""
        files = self.files_for(keys, version)
        if not files:
            return self.current(F.lit(False), version)
        schema = self.spark.table(self.name).schema
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*files)
        return self._merged(rows.join(keys.select(self.key).distinct(), self.key, "left_semi").select(*self.columns))

    # --- upkeep --------------------------------------------------------------------------------

    def _folded(self, compaction: Commit) -> set[tuple[int, int]]:
        said = json.loads(storage.read_text(self.spark, f"{self.path}/folded/{compaction.id}.json") or "[]")
        return {tuple(x) for x in said}

    def compact(self) -> int:
        """Fold all commits but each run's newest batch into one. Commits that arrive meanwhile stay."""
        _, live = self.snapshot()
        newest = {r: max(c.batch_id for c in live if c.run_id == r) for r in {c.run_id for c in live} - {-1}}
        old = [c for c in live if c.batch_id != newest.get(c.run_id)]
        if len(old) < 2:
            return self.snapshot()[0]
        commit, n = self._write(self._merged(self._rows(old)))
        folded = {(c.run_id, c.batch_id) for c in old if c.run_id != -1}.union(*(self._folded(c) for c in old if c.run_id == -1))
        storage.create_exclusive(self.spark, f"{self.path}/folded/{commit}.json", json.dumps(sorted(folded)))
        gone = {c.id for c in old}

        def swap(now: list[Commit]) -> list[Commit]:
            if not gone.issubset(c.id for c in now):
                raise RuntimeError("a compacted batch was replaced meanwhile; compact again")
            return [Commit(commit, -1, 0, n)] + [c for c in now if c.id not in gone]
        return self._commit(swap)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the commits that none of the last ``keep`` versions names; run it while nobody writes. Returns their ids."""
        versions = self.versions()[-keep:]
        held = {c.id for v in versions for c in self._read_log(v) or []}
        gone = [n.split("=", 1)[1] for n in storage.names(self.spark, f"{self.path}/data") if n.startswith("commit=") and n.split("=", 1)[1] not in held]
        if gone:
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        for i in gone:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (commit='{i}')")
            for place in (f"data/commit={i}", f"files/{i}", f"blooms/{i}"):
                storage.delete(self.spark, f"{self.path}/{place}")
            self._known.discard(i)
        return gone


def buckets_for(rows: DataFrame, bucket_bytes: int = 128 << 20) -> int:
    """Buckets that hold about ``bucket_bytes`` of the optimizer's estimate each; at least as many as there are tasks at once."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-(estimated_bytes(rows) or 0) // bucket_bytes))


def join_tables(tables: list[KeyedTable], how: str = "left") -> DataFrame:
    """The current rows of tables of the same key and buckets, joined by it bucket by bucket, without an exchange."""
    first, *rest = tables
    if any((x.key, x.buckets, x.schema[x.key].dataType) != (first.key, first.buckets, first.schema[first.key].dataType) for x in rest):
        raise ValueError("tables that are joined need the same key, type of key and number of buckets")
    names = [n for x in tables for n in x.schema.names if n != first.key]
    if len(set(names)) != len(names):
        raise ValueError(f"columns of the same name: {sorted({n for n in names if names.count(n) > 1})}")
    joined = first.current().drop(*VERSION)
    for x in rest:
        joined = joined.join(x.current().drop(*VERSION).hint("merge"), first.key, how)
    return joined
