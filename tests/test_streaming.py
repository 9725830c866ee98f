"""Replay safety of the ingest -> store stream: rerun on the same checkpoint, fail a
batch half-way and retry, restart with a new checkpoint (new run id, other batch
boundaries). The current view must be the same every time, and equal the static one."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from vigil.config import StreamConfig
from vigil.sinks.envelope import encode
from vigil.operators.upsert import dedupe_in_batch
from vigil.sinks.keyed_table import KeyedTable
from vigil.sinks.store import read_store, write_batch
from vigil.sources.stream import RECORD_SCHEMA, read_stream
from vigil.streaming import jobs
from vigil.streaming.replay import write_pieces


def _records(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "lang", "n_chars")
    items = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("label"),
                        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
                        F.lit("train").alias("split"), (F.col("doc_id") % 4).cast("int").alias("piece"))
    return encode(items, "training", carry=("piece",))


def _featurize(good):
    return good.select("id", "label", "url", F.length("url").cast("long").alias("url_len"))


def _stream(spark, topic, files_per_trigger):
    cfg = StreamConfig(format="parquet", max_files_per_trigger=files_per_trigger)
    return read_stream(spark, cfg, topic, RECORD_SCHEMA).select("key", "value")


def _view(spark, store):
    return sorted(tuple(r) for r in KeyedTable.open(spark, store).current().select("id", "label", "url", "url_len").collect())


def test_replay_rerun_fail_and_new_checkpoint(spark, scratch):
    topic, store, ck1, ck2 = scratch("topic"), scratch("store"), scratch("ck"), scratch("ck")
    write_pieces(_records(spark), topic, "piece")

    r1 = jobs.ingest_to_store(_stream(spark, topic, 1), store, ck1, _featurize)
    first = _view(spark, store)
    expected = sorted((str(r.doc_id), r.lang, f"doc://{r.doc_id}", len(f"doc://{r.doc_id}"))
                      for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect())
    assert first == expected and r1.batches == 4 and r1.run_id == 0

    # same checkpoint again: nothing new, same run id, same view
    r2 = jobs.ingest_to_store(_stream(spark, topic, 1), store, ck1, _featurize)
    assert r2.run_id == 0 and r2.batches == 0 and _view(spark, store) == first

    # new checkpoint, other batch boundaries: new run id, batch 0 of run 0 not overwritten
    r3 = jobs.ingest_to_store(_stream(spark, topic, 3), store, ck2, _featurize)
    assert r3.run_id == 1 and r3.batches == 2 and _view(spark, store) == first
    runs = {(c.run_id, c.batch_id) for c in KeyedTable.open(spark, store).snapshot()[1]}
    assert {(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 1)} <= runs


def test_failed_batch_is_retried(spark, scratch):
    topic, store, ck = scratch("topic"), scratch("store"), scratch("ck")
    write_pieces(_records(spark), topic, "piece")
    calls = {"n": 0}

    def flaky(good):
        calls["n"] += 1
        if calls["n"] == 2:  # second micro-batch fails once, after part of the run committed
            raise RuntimeError("executor lost")
        return _featurize(good)

    with pytest.raises(Exception):
        jobs.ingest_to_store(_stream(spark, topic, 1), store, ck, flaky)
    partial = {c.batch_id for c in KeyedTable.open(spark, store).snapshot()[1]}
    assert partial == {0}
    jobs.ingest_to_store(_stream(spark, topic, 1), store, ck, flaky)  # restart from the checkpoint
    expected = sorted((str(r.doc_id), r.lang, f"doc://{r.doc_id}", len(f"doc://{r.doc_id}"))
                      for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect())
    assert _view(spark, store) == expected


def test_dedupe_within_watermark(spark, scratch):
    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    ev = spark.read.parquet(f"{SF0001}/events.parquet").select("event_id", "ts", "event_type")
    from vigil.streaming.replay import write_ordered

    ev = ev.withColumn("piece", (F.col("event_id") / 250).cast("int"))
    write_ordered(ev, src, "piece", [0, 1, 2, 3], replay_previous=True)
    stream = (spark.readStream.schema("event_id long, ts timestamp_ntz, event_type string, piece int")
              .option("maxFilesPerTrigger", 1).parquet(src).withColumn("ts", F.col("ts").cast("timestamp")))
    jobs.append_parquet(jobs.dedupe(stream, "event_id", "ts", "30 days").select("event_id", "event_type"), out, ck)
    got = spark.read.parquet(out)
    assert got.count() == 1000 and got.select("event_id").distinct().count() == 1000


def test_write_pieces_salted_split(spark, scratch):
    import glob

    path = scratch("pieces")
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("piece"))
    # AQE merges tiny shuffle partitions (right at this size); switch that off to see
    # the split a large piece gets
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_pieces(df, path, "piece", files_per_piece=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    local = path.replace("file:", "")
    assert len(glob.glob(f"{local}/piece=1/*.parquet")) >= 3
    back = spark.read.parquet(path)
    assert back.count() == 3000 and back.select("id").distinct().count() == 3000


def test_publish_manifest_end_to_end(spark, scratch):
    import os

    from vigil.sources.envelope import decode
    from vigil.streaming.producer import publish_manifest

    media = scratch("media").replace("file:", "")
    os.makedirs(f"{media}/val/horrible")
    with open(f"{media}/val/horrible/0003.mp4", "wb") as fh:
        fh.write(b"abc")
    manifest = spark.createDataFrame(
        [(f"{media}/val/horrible/0003.mp4", "horrible", [0.5, 0.25, 1.0], "val"),
         (f"{media}/val/horrible/0009.mp4", "horrible", None, "val")],
        "url string, label string, text_embedding array<float>, flag string")
    topic = scratch("topic")
    cfg = StreamConfig(format="parquet", mode="inference")
    publish_manifest(spark, manifest, cfg, topic, media_root=media)
    stream = read_stream(spark, cfg, topic, RECORD_SCHEMA)
    q = stream.writeStream.format("memory").queryName("manifest_topic").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = {r.url.rsplit("/", 1)[1]: r for r in decode(spark.table("manifest_topic"), "inference").collect()}
    ok, missing = rows["0003.mp4"], rows["0009.mp4"]
    assert ok.status == "good" and ok.video_encoded == "YWJj" and ok.text_embedding == [0.5, 0.25, 1.0]
    assert ok.id == __import__("hashlib").sha256(f"val:{media}/val/horrible/0003.mp4".encode()).hexdigest()
    assert missing.status == "good" and missing.video_encoded is None and missing.split == "val"


def test_junk_and_last_write_within_a_batch(spark, scratch):
    """Nothing is lost: good + quarantined = sent, raw bytes kept; the later record wins."""
    topic, store, landing = scratch("topic"), scratch("store"), scratch("landing")
    old = encode(spark.createDataFrame([("a", "old"), ("b", "only")], "id string, label string"), "training")
    new = encode(spark.createDataFrame([("a", "new")], "id string, label string"), "training")
    junk = spark.createDataFrame([(b"k", b"junk"), (b"x", b'{"x":1}')], "key binary, value binary")
    sent = old.unionByName(junk).unionByName(new).coalesce(1)
    sent.write.parquet(topic)
    keep = lambda good: good.select("id", "label")
    jobs.ingest_to_store(_all(spark, topic), store, scratch("ck"), keep)
    assert sorted(tuple(r) for r in KeyedTable.open(spark, store).current().select("id", "label").collect()) == [("a", "new"), ("b", "only")]
    jobs.land(_all(spark, topic), landing, scratch("ck"), keep, mode="training")
    assert read_store(spark, landing).count() == 3
    for table in (store, landing):
        bad = read_store(spark, jobs.quarantine_of(table)).select("key", "value", "reason").collect()
        assert sorted((bytes(r.key), bytes(r.value), r.reason) for r in bad) == [(b"k", b"junk", "malformed"), (b"x", b'{"x":1}', "missing_id")]


def _all(spark, topic):
    return read_stream(spark, StreamConfig(format="parquet"), topic, RECORD_SCHEMA)


def test_two_checkpoints_never_share_a_run_id(spark, scratch):
    table, a, b = scratch("store"), scratch("ck"), scratch("ck")
    first, second = jobs.run_id_for(spark, a, table), jobs.run_id_for(spark, b, table)  # neither has written yet
    assert first != second and jobs.run_id_for(spark, a, table) == first


def test_order_may_not_be_the_key(spark):
    with pytest.raises(ValueError):
        dedupe_in_batch(spark.range(3), "id", "id")


def test_a_landed_batch_replaces_itself(spark, scratch):
    path = scratch("landing")
    for batch, n in ((0, 5), (1, 4), (1, 2), (0, 0)):  # sent again with fewer rows, and with none
        write_batch(spark.range(n), path, 3, batch)
    assert [tuple(r) for r in read_store(spark, path).groupBy("run_id", "batch_id").count().collect()] == [(3, 1, 2)]


def test_triggers_are_as_many_as_pieces_however_many_files(spark, monkeypatch):
    """A trigger may read a whole table, so their number must not grow with the input."""
    from vigil.plans import streams
    from vigil.streaming import jobs as j, replay

    seen = []
    plain = j.batch_stats
    monkeypatch.setattr(j, "batch_stats", lambda *a: seen.append(plain(*a)))
    monkeypatch.setattr(replay, "FILE_BYTES", 1 << 9)
    rows = streams.replay_batches(spark, "/root/testdata/sf0.001").collect()
    assert sum(r.n_rows for r in rows) == 200 and 1 <= seen[0].batches <= streams.PIECES
