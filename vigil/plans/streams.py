"""Streaming queries (OP-01, OP-55, OP-60..64, OP-66): each pushes a given table
through a file stream of ``key, value`` records (the Kafka layout) and must give the
same result as the static query. All scratch state (records, checkpoints, stores)
lives under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.config import StreamConfig
from vigil.functions import text as tx
from vigil.operators.split import hash_split
from vigil.plans.catalog import query, sql_hash_split, t
from vigil.session import scratch_path
from vigil.sinks.chunks import parsed, split_messages
from vigil.sinks.envelope import encode
from vigil.sinks.keyed_table import KeyedTable
from vigil.sinks.store import read_store
from vigil.sources.envelope import decode
from vigil.sources.stream import RECORD_SCHEMA, read_stream
from vigil.sources.tables import heavy_table
from vigil.streaming import jobs
from vigil.streaming.assemble import Messages, assemble
from vigil.streaming.dedupe import Accounts, dedupe_accounted
from vigil.streaming.replay import write_ordered, write_pieces
from vigil.streaming.report import read_report, report_as_it_arrives

PIECES = 8  # the table is replayed in this many ordered pieces, the files of one per trigger


def _ordered_pieces(df: DataFrame, id_col: str) -> DataFrame:
    """Ordered piece number 0..PIECES-1 of an increasing id (one scalar max fetched)."""
    top = df.agg(F.max(id_col)).first()[0]
    width = (int(top) + 1 + PIECES - 1) // PIECES if top is not None else 1
    return df.withColumn("piece", F.floor(F.col(id_col) / F.lit(width)).cast("int"))


def _record_schema() -> T.StructType:
    return T.StructType([*RECORD_SCHEMA.fields, T.StructField("piece", T.IntegerType())])


def _publish_records(records: DataFrame, path: str) -> StreamConfig:
    """Write ``key, value`` records as ordered files (the topic stand-in); how to read them, a piece a trigger."""
    return StreamConfig(format="parquet", max_files_per_trigger=write_pieces(records, path, "piece", pieces=PIECES))


def _doc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = hash_split(t(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    items = (docs.withColumn("url", F.concat(F.lit("doc://"), F.col("doc_id").cast("string")))
             .withColumnRenamed("lang", "label").withColumnRenamed("doc_id", "id"))
    items = _ordered_pieces(items, "id")
    # every tenth item is announced a second time under an id that has no media
    lost = items.where(F.col("id") % 10 == 3).withColumn("id", F.concat(F.lit("lost-"), F.col("id").cast("string")))
    junk = items.where(F.col("id") % 10 == 4).select(
        F.concat(F.lit("junk-"), F.col("id").cast("string")).cast("binary").alias("key"),
        F.concat(F.lit("{broken "), F.col("id").cast("string")).cast("binary").alias("value"), "piece")
    items = items.withColumn("id", F.col("id").cast("string")).unionByName(lost)
    return encode(items, "training", carry=("piece",)).unionByName(junk)


def doc_features(spark: SparkSession, sf_dir: str) -> callable:
    """Path strategy: features are looked up by the item id in the media table. An item whose
    media is missing keeps its row with zero features and a status. The join is by key of
    any kind, of the sizes and not of the texts; a media table bucketed by key spares its shuffle."""
    size = lambda sep: F.size(F.split("text", sep)).cast("long")
    media = t(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        F.col("doc_id").cast("string").alias("id"), size(" ").alias("n_words"), size("\n").alias("n_lines"), F.lit(True).alias("found"))

    def featurize(good: DataFrame) -> DataFrame:
        joined = good.select("id", "label", "split").join(media, "id", "left")
        count = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
        return joined.select("id", "label", "split", count("n_words"), count("n_lines"),
                             F.when(F.col("found").isNull(), "missing").otherwise("ok").alias("status"))
    return featurize


@query("stream_feature_store", "OP-60 OP-01 OP-55 OP-18 OP-62", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, lang AS label, {sql_hash_split('doc_id')} AS split,
       CAST(len(string_split(text, ' ')) AS BIGINT) AS n_words,
       CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines, 'ok' AS status
FROM documents
UNION ALL SELECT 'lost-' || CAST(doc_id AS VARCHAR), lang, {sql_hash_split('doc_id')}, 0, 0, 'missing' FROM documents WHERE doc_id % 10 = 3
UNION ALL SELECT 'junk-' || CAST(doc_id AS VARCHAR), NULL, NULL, NULL, NULL, 'malformed' FROM documents WHERE doc_id % 10 = 4
""")
def stream_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, store, ckpt = (scratch_path(spark, n) for n in ("topic", "store", "ckpt"))
    records = _doc_records(spark, sf_dir)
    pace = _publish_records(records, topic)
    pace_again = _publish_records(records.where(F.col("piece") == 0), topic + "_replay")  # a replayed piece
    stream = read_stream(spark, pace, topic, _record_schema()).drop("piece")
    jobs.ingest_to_store(stream, store, ckpt, doc_features(spark, sf_dir), by=("split",))
    # the replay arrives later through a second query on the same store (new run id)
    replay = read_stream(spark, pace_again, topic + "_replay",
                         _record_schema()).drop("piece")
    jobs.ingest_to_store(replay, store, scratch_path(spark, "ckpt"), doc_features(spark, sf_dir), by=("split",))
    current = KeyedTable.open(spark, store).current().select("id", "label", "split", "n_words", "n_lines", "status")
    # what was announced = stored + quarantined; a replayed record is quarantined again, in its own run
    bad = read_store(spark, jobs.quarantine_of(store)).where("run_id = 0")
    none = F.lit(None)
    return current.unionByName(bad.select(
        F.col("key").cast("string").alias("id"), none.cast("string").alias("label"), none.cast("string").alias("split"),
        none.cast("long").alias("n_words"), none.cast("long").alias("n_lines"), F.col("reason").alias("status")))


def page_payload_features(good: DataFrame) -> DataFrame:
    """Payload strategy: features from the decoded media bytes, zero fallback + status."""
    status = tx.payload_status("video_encoded")
    body = F.when(status == "ok", tx.b64decode_guarded("video_encoded")).cast("string")
    return good.select("id", "url", status.alias("payload_status"),
                       F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"),
                       F.coalesce(F.length(body) - F.length(F.replace(body, F.lit("<"), F.lit(""))),
                                  F.lit(0)).cast("long").alias("n_tags"))


@query("stream_land", "OP-61 OP-62 OP-10 OP-14", """
SELECT CAST(page_id AS VARCHAR) AS id, url, 'ok' AS payload_status, CAST(strlen(html) AS BIGINT) AS n_bytes,
       CAST(length(html) - length(replace(html, '<', '')) AS BIGINT) AS n_tags
FROM pages
UNION ALL SELECT 'junk-' || CAST(page_id AS VARCHAR), NULL, 'malformed', strlen('{{broken ' || CAST(page_id AS VARCHAR)), NULL
FROM pages WHERE page_id % 10 = 4
""".replace("{{", "{"))
def stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, landing, ckpt = (scratch_path(spark, n) for n in ("topic", "landing", "ckpt"))
    pages = heavy_table(spark, sf_dir, "pages", "page_id", "url", "html")
    items = pages.withColumn("video_encoded", tx.b64encode(F.encode("html", "UTF-8"))).withColumnRenamed("page_id", "id")
    records = encode(items.withColumn("piece", (F.col("id") % PIECES).cast("int")), "inference", carry=("piece",))
    junk = pages.where(F.col("page_id") % 10 == 4).select(
        F.concat(F.lit("junk-"), F.col("page_id").cast("string")).cast("binary").alias("key"),
        F.concat(F.lit("{broken "), F.col("page_id").cast("string")).cast("binary").alias("value"),
        (F.col("page_id") % PIECES).cast("int").alias("piece"))
    pace = _publish_records(records.unionByName(junk), topic)
    stream = read_stream(spark, pace, topic, _record_schema()).drop("piece")
    jobs.land(stream, landing, ckpt, page_payload_features, mode="inference")
    bad = read_store(spark, jobs.quarantine_of(landing))
    return read_store(spark, landing).select("id", "url", "payload_status", "n_bytes", "n_tags").unionByName(bad.select(
        F.col("key").cast("string").alias("id"), F.lit(None).cast("string").alias("url"), F.col("reason").alias("payload_status"),
        F.octet_length("value").cast("long").alias("n_bytes"), F.lit(None).cast("long").alias("n_tags")))


@query("stream_dedupe", "OP-66 OP-64", """
SELECT event_id, event_type, value FROM events
""")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece re-sends the previous one; duplicates are dropped within a 16-day
    watermark. Pieces arrive in event-time order, so an original is never behind the
    watermark; the delay covers the replay distance (two pieces of under 8 days)."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("events_src", "dedup", "ckpt"))
    ev = t(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    pieces = _ordered_pieces(ev, "event_id")
    files = write_ordered(pieces, src, "piece", list(range(PIECES)), replay_previous=True)
    schema = "event_id long, ts timestamp_ntz, event_type string, value double, piece int"
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(src)
              .withColumn("ts", F.col("ts").cast("timestamp")))
    deduped = jobs.dedupe(stream, "event_id", "ts", "16 days").select("event_id", "event_type", "value")
    jobs.append_parquet(deduped, out, ckpt)
    return spark.read.parquet(out)


DELAY_S = 2 * 24 * 3600

_SQL_PIECE = f"event_id // ((SELECT max(event_id) FROM events) // {PIECES} + 1)"


@query("stream_dedupe_accounts", "OP-66 OP-64", f"""
WITH e AS (SELECT event_id, ts, event_type, {_SQL_PIECE} AS piece FROM events),
sent AS (SELECT *, piece AS sent_in, 'kept' AS outcome FROM e
  UNION ALL SELECT *, piece, 'duplicate' FROM e WHERE event_id % 7 = 0
  UNION ALL SELECT *, piece + 1, 'again' FROM e WHERE event_id % 5 = 0 AND piece + 1 < {PIECES}),
mark AS (SELECT sent_in, max(max(ts)) OVER (ORDER BY sent_in ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - to_seconds({DELAY_S}) AS w FROM sent GROUP BY 1)
SELECT event_type, CASE WHEN ts < w THEN 'late' WHEN outcome = 'kept' THEN 'kept' ELSE 'duplicate' END AS outcome, CAST(count(*) AS BIGINT) AS n
FROM sent JOIN mark USING (sent_in) GROUP BY 1, 2
""")
def stream_dedupe_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events are sent twice in their piece, some again in the next one, where part of them is behind the
    watermark. Everything sent is kept, counted as a duplicate, or written as late."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("events_src", "accounts", "ckpt"))
    ev = _ordered_pieces(t(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type"), "event_id")
    twice = ev.where(F.col("event_id") % 7 == 0)
    again = ev.where((F.col("event_id") % 5 == 0) & (F.col("piece") + 1 < PIECES)).withColumn("piece", F.col("piece") + 1)
    files = write_ordered(ev.unionByName(twice).unionByName(again), src, "piece", list(range(PIECES)))
    stream = spark.readStream.schema("event_id long, ts timestamp, event_type string, piece int").option("maxFilesPerTrigger", files).parquet(src).drop("piece")
    dedupe_accounted(stream, "event_id", "ts", DELAY_S, out, ckpt)
    found = Accounts(out)
    types = t(spark, sf_dir, "events").select("event_id", "event_type")
    parts = [found.read(spark, "kept").select("event_type", F.lit("kept").alias("outcome"), F.lit(1).alias("n")),
             found.read(spark, "late").select("event_type", F.lit("late").alias("outcome"), F.lit(1).alias("n")),
             found.read(spark, "duplicates").select("event_id", "n").join(types, "event_id").select("event_type", F.lit("duplicate").alias("outcome"), "n")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("event_type", "outcome").agg(F.sum("n").cast("long").alias("n"))


@query("replay_batches", "OP-64 OP-55 OP-40", f"""
SELECT CAST(doc_id % {PIECES} AS INTEGER) AS piece, CAST(count(*) AS BIGINT) AS n_rows
FROM documents GROUP BY 1
""")
def replay_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces paced one file per trigger; per-batch counts recorded, then summed."""
    src, stats, ckpt = (scratch_path(spark, n) for n in ("pieces", "stats", "ckpt"))
    docs = t(spark, sf_dir, "documents").select("doc_id", "lang")
    files = write_pieces(docs.withColumn("piece", (F.col("doc_id") % PIECES).cast("int")), src, "piece", pieces=PIECES)
    stream = spark.readStream.schema("doc_id long, lang string, piece int").option("maxFilesPerTrigger", files).parquet(src)
    jobs.batch_stats(stream, stats, ckpt, "piece")
    per_batch = read_store(spark, stats)
    return per_batch.groupBy("piece").agg(F.sum("n_rows").cast("long").alias("n_rows"))


@query("stream_ingest", "OP-01 OP-13 OP-55 OP-63", f"""
SELECT CAST(page_id AS VARCHAR) AS id, url, {sql_hash_split('page_id')} AS split, 'good' AS status FROM pages
""")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.plans.envelopes import page_items

    topic, out, ckpt = (scratch_path(spark, n) for n in ("topic", "ingest", "ckpt"))
    records = encode(page_items(spark, sf_dir).withColumnRenamed("page_id", "id"), "training")
    pace = _publish_records(records.withColumn("piece", (F.col("key").cast("string").cast("long") % PIECES).cast("int")), topic)
    stream = read_stream(spark, pace, topic, _record_schema()).drop("piece")
    decoded = decode(stream, "training").select("id", "url", "split", "status")
    jobs.append_parquet(decoded, out, ckpt)
    return spark.read.parquet(out)


LIMIT, LONGEST = 1000, 10_000  # bytes of a record, bytes of a message

_SQL_CHUNKED = f"(strlen(html) + strlen(CAST(page_id AS VARCHAR)) > {LIMIT})"


@query("stream_chunked_messages", "OP-08 OP-01", f"""
SELECT CAST(page_id AS VARCHAR) AS id,
       CASE WHEN strlen(html) > {LONGEST} THEN 'too_large' WHEN page_id % 10 = 7 AND {_SQL_CHUNKED} THEN 'waiting' ELSE 'delivered' END AS outcome,
       CASE WHEN strlen(html) <= {LONGEST} AND NOT (page_id % 10 = 7 AND {_SQL_CHUNKED}) THEN CAST(strlen(html) AS BIGINT) END AS n_bytes,
       CASE WHEN strlen(html) <= {LONGEST} AND NOT (page_id % 10 = 7 AND {_SQL_CHUNKED}) THEN md5(html) END AS html_md5
FROM pages
""")
def stream_chunked_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages beyond the topic's limit travel in parts, which arrive in different triggers. Some first parts come twice,
    some never; pages beyond the longest message are refused when they are sent. Every page is accounted for."""
    topic, out, ckpt = (scratch_path(spark, n) for n in ("topic", "messages", "ckpt"))
    pages = heavy_table(spark, sf_dir, "pages", "page_id", "html")
    records = pages.select(F.col("page_id").cast("string").cast("binary").alias("key"), F.encode("html", "UTF-8").alias("value"), "page_id")
    ok, refused = split_messages(records, LIMIT, LONGEST)
    ok = parsed(ok).withColumn("piece", F.pmod(F.col("page_id") + F.coalesce("part", F.lit(0)), F.lit(PIECES)).cast("int"))
    first = F.coalesce(F.col("part") == 0, F.lit(False))
    again = ok.where(first & (F.col("page_id") % 10 == 2)).withColumn("piece", F.lit(PIECES - 1))
    sent = ok.where(~(first & (F.col("page_id") % 10 == 7))).unionByName(again).select("key", "value", "piece")
    pace = _publish_records(sent, topic)
    stream = read_stream(spark, pace, topic, _record_schema()).drop("piece")
    assemble(stream, out, ckpt)
    found = Messages(out)
    none = F.lit(None)
    delivered = found.read(spark, "delivered").select("key", F.lit("delivered").alias("outcome"), F.octet_length("value").cast("long").alias("n_bytes"), F.md5("value").alias("html_md5"))
    rest = [found.read(spark, "undeliverable").select("key", F.col("reason").alias("outcome")),
            found.waiting(spark).select("key", F.lit("waiting").alias("outcome")), refused.select("key", F.col("reason").alias("outcome"))]
    for r in rest:
        delivered = delivered.unionByName(r.withColumn("n_bytes", none.cast("long")).withColumn("html_md5", none.cast("string")))
    return delivered.select(F.col("key").cast("string").alias("id"), "outcome", "n_bytes", "html_md5")


@query("stream_report", "OP-75 OP-40 OP-33", """
SELECT d.lang, CASE WHEN l.toxic = 1 THEN 'offensive' ELSE 'normal' END AS predicted_label,
       CAST(count(*) AS BIGINT) AS n_items, CAST(sum(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_sensitive,
       CAST(sum(d.n_chars) AS BIGINT) AS n_chars, CAST(max(d.doc_id) AS BIGINT) AS last_id
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
GROUP BY 1, 2
""")
def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moderation report kept up as documents arrive, piece by piece."""
    from vigil.plans.moderation import with_predictions

    src, out, ckpt = (scratch_path(spark, n) for n in ("pieces", "report", "ckpt"))
    docs = t(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    pieces = _ordered_pieces(docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("n_chars", F.col("n_chars").cast("long")), "doc_id")
    files = write_pieces(pieces, src, "piece", pieces=PIECES)
    stream = spark.readStream.schema("doc_id long, lang string, n_chars long, piece int").option("maxFilesPerTrigger", files).parquet(src).drop("piece")
    measures = [F.count("*").alias("n_items"), F.sum(F.col("sensitive").cast("long")).alias("n_sensitive"),
                F.sum("n_chars").alias("n_chars"), F.max("doc_id").alias("last_id")]
    report_as_it_arrives(with_predictions(stream, spark, sf_dir), ["lang", "predicted_label"], measures, out, ckpt)
    return read_report(spark, out).select("lang", "predicted_label", "n_items", "n_sensitive", "n_chars", "last_id")
