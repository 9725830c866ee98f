"""Exact deduplication against a persistent index of digests, bucketed and sorted by digest.

The index is a table in a folder: one row ``digest, id`` per distinct text, dealt to buckets and
sorted by the SHA-256 of the text, so that the join with it moves and reads no text and shuffles
only the new side. New data is reduced to its distinct digests (partial aggregation first: a group
of copies is one row per task), joined to the index by a sort-merge anti-join, and what isn't there
is appended. First come stays; within one batch the largest id does.

Appends are commits: a folder of new rows, then one row of the log that names the commits which
are valid from now on. Whatever a lost driver or executor leaves without a log row is never read, a
batch that is sent again takes the place of its earlier attempt, and ``compact`` rewrites all
commits as one while readers of the old snapshot go on. One writer at a time.

Native: DataFrame functions and SQL only. ``verdicts`` gives each row its group. Groups of more
than one in ``HOT_GROUPS`` of all rows (there can't be more than ``HOT_GROUPS`` of them) meet their rows
by a broadcast, so a text that a third of all rows share lands in no single task.

Defined results: a null text is empty, and empty texts are equal to each other. A row without an id is given
up for any row with one; if a text has no row with an id, all its rows stay and their ``keep_id`` is
null. Rows that repeat id and text are all kept or all dropped (and count in ``group_size``). An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import materialize, partitions_for, with_groups
from vigil.session import scratch_path

ARRIVALS = 4


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id long, digest binary`` of each row."""
    return docs.select(F.col(id_col).cast("long").alias("id"),
                       F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)).alias("digest"))


class DigestIndex:
    """The index in ``folder``; made by ``create`` or ``open``."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int):
        self.spark, self.folder, self.buckets = spark, folder, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"  # the catalog's name for the folder, of this session only
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, id BIGINT, commit STRING) USING parquet PARTITIONED BY (commit) "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}/entries'")

    @classmethod
    def create(cls, spark: SparkSession, folder: str, buckets: int | None = None) -> DigestIndex:
        """An empty index. With as many buckets as shuffle partitions (the default), new data is shuffled once."""
        index = cls(spark, folder, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        index._log([], 0)
        return index

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> DigestIndex:
        try:
            buckets = spark.read.parquet(f"{folder}/log").agg(F.max("buckets")).first()[0]
        except AnalysisException as e:
            raise FileNotFoundError(f"no digest index in {folder}") from e
        index = cls(spark, folder, buckets)
        if index.snapshot()[1]:
            spark.sql(f"ALTER TABLE {index.table} RECOVER PARTITIONS")
        return index

    def _log(self, commits: list[tuple[int, str]], version: int) -> None:
        row = self.spark.range(1).select(F.lit(version).alias("version"), F.lit(self.buckets).alias("buckets"), F.array(
            *[F.struct(F.lit(b).alias("batch"), F.lit(c).alias("commit")) for b, c in commits]).cast("array<struct<batch:int,commit:string>>").alias("commits"))
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def snapshot(self) -> tuple[int, list[tuple[int, str]]]:
        """The last version and its commits ``(batch, commit)``: one per batch since the last compaction."""
        last = self.spark.read.parquet(f"{self.folder}/log").orderBy(F.desc("version")).first()
        return last.version, [(c.batch, c.commit) for c in last.commits]

    def entries(self, but: int | None = None) -> DataFrame:
        """``digest, id`` of each distinct text (of all batches, or all but one)."""
        commits = [c for b, c in self.snapshot()[1] if b != but]
        return self.spark.table(self.table).where(F.col("commit").isin(commits)).select("digest", "id")

    def unseen(self, digests: DataFrame, but: int | None = None) -> DataFrame:
        """``digest, id`` of the texts that aren't in the index, each once, with its largest id."""
        new = digests.groupBy("digest").agg(F.max("id").alias("id"))
        return new.join(self.entries(but).hint("merge"), "digest", "left_anti")

    def add(self, digests: DataFrame, batch: int) -> None:
        """Append what is new in ``digests``; the same batch again replaces what it added before."""
        commit = uuid.uuid4().hex
        (self.unseen(digests, batch).withColumn("commit", F.lit(commit)).write.insertInto(self.table))
        version, commits = self.snapshot()
        self._log([(b, c) for b, c in commits if b != batch] + [(batch, commit)], version + 1)

    def compact(self) -> None:
        """Rewrite all commits as one (batch -1), with one file a bucket."""
        commit = uuid.uuid4().hex
        version = self.snapshot()[0]
        (self.entries().repartition(self.buckets, "digest").withColumn("commit", F.lit(commit)).write.insertInto(self.table))
        self._log([(-1, commit)], version + 1)

    def verdicts(self, digests: DataFrame) -> DataFrame:
        """``id, keep_id, group_size, kept, digest`` of each row of ``digests``, whose texts are all in the index."""
        sizes = digests.groupBy("digest").agg(F.count("*").alias("group_size"))
        groups = sizes.join(self.entries().withColumnRenamed("id", "keep_id").hint("merge"), "digest", "left")
        rows = with_groups(digests, materialize(groups, "groups"), "digest", "group_size")
        return rows.select("id", "keep_id", "group_size",
                           F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "digest")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", arrivals: int = ARRIVALS, folder: str | None = None) -> DataFrame:
    """Verdicts on all rows by a new index: they arrive in batches of descending ids, so the largest id stays."""
    spark = docs.sparkSession
    digests = materialize(digest_rows(docs, id_col, text_col), "digests")
    index = DigestIndex.create(spark, folder or scratch_path(spark, "digest-index"), partitions_for(docs))
    shares = [i / arrivals for i in range(1, arrivals)]
    cuts = sorted(set(digests.agg(F.percentile_approx("id", shares, 1000)).first()[0] or []), reverse=True)
    below = None
    for batch, cut in enumerate([*cuts, None]):
        here = F.lit(True) if cut is None else F.col("id") >= cut
        if below is not None:
            here &= F.col("id").isNull() | (F.col("id") < below)
        index.add(digests.where(F.coalesce(here, F.lit(False))), batch)
        below = cut
    return index.verdicts(digests)
