"""Sources and sinks not covered by a registered query: whole-file manifests, media
directory scan + class index, payload load by path, publish to a file topic, config."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from vigil.config import EngineConfig, StreamConfig
from vigil.sinks.envelope import encode, publish
from vigil.sources.envelope import decode
from vigil.sources.files import class_index, load_payloads, scan_media
from vigil.sources.manifest import read_manifest_files, read_manifest_lines, write_manifest
from vigil.sources.stream import kafka_available, read_stream


def _local(path):
    return path.replace("file:", "")


def test_manifest_files_and_lines(spark, scratch):
    root = _local(scratch("manifests"))
    os.makedirs(root)
    val = {"horrible_0003": {"url": "/data/val/horrible/0003.mp4", "label": "horrible"},
           "normal_video_1_part_002": {"url": "/data/val/normal/video_1_part_002.mp4", "label": "normal"}}
    test = {"horrible_0003": {"url": "/data/test/horrible/0003.mp4", "label": "horrible"}}
    for name, doc in (("val", val), ("test", test)):
        with open(f"{root}/{name}.json", "w") as fh:
            json.dump(doc, fh, indent=4)
    rows = read_manifest_files(spark, root).withColumn(
        "split", F.regexp_extract("source_file", r"/([^/]+)\.json$", 1)).collect()
    got = sorted((r.split, r.idx, r.url, r.label) for r in rows)
    assert got == [("test", "horrible_0003", "/data/test/horrible/0003.mp4", "horrible"),
                   ("val", "horrible_0003", "/data/val/horrible/0003.mp4", "horrible"),
                   ("val", "normal_video_1_part_002", "/data/val/normal/video_1_part_002.mp4", "normal")]
    lines = scratch("lines")
    counts = write_manifest(spark.createDataFrame([(r.idx, r.url, r.label, r.split) for r in rows],
                                                  "idx string, url string, label string, split string"), lines)
    assert {r.split: r.n_items for r in counts.collect()} == {"val": 2, "test": 1}
    assert read_manifest_lines(spark, lines).count() == 3


def test_directory_scan_class_index_and_payloads(spark, scratch):
    root = _local(scratch("media"))
    for label, names in (("violent", ["a.MP4", "b.mov", "notes.txt"]), ("horrible", ["c.mkv", "empty.avi"])):
        os.makedirs(f"{root}/{label}")
        for n in names:
            with open(f"{root}/{label}/{n}", "wb") as fh:
                fh.write(b"" if n.startswith("empty") else n.encode())
    files = scan_media(spark, root)
    # zero-length files are skipped by Spark's file sources
    assert sorted(os.path.basename(r.path) for r in files.collect()) == ["a.MP4", "b.mov", "c.mkv"]
    idx = {os.path.basename(r.path): (r.label, r.class_idx) for r in class_index(files).collect()}
    assert idx["a.MP4"] == ("violent", 1) and idx["c.mkv"] == ("horrible", 0)
    wanted = spark.createDataFrame([(f"{root}/violent/a.MP4",), (f"{root}/horrible/empty.avi",),
                                    (f"{root}/horrible/missing.mp4",)], "url string")
    got = {os.path.basename(r.url): (r.payload, r.payload_status) for r in load_payloads(spark, wanted, root).collect()}
    assert got == {"a.MP4": ("YS5NUDQ=", "ok"), "empty.avi": (None, "empty"), "missing.mp4": (None, "missing")}


def test_publish_to_file_topic_and_read_back(spark, scratch):
    topic = scratch("topic")
    items = spark.read.parquet(f"{SF0001}/pages.parquet").select(F.col("page_id").alias("id"), "url")
    cfg = StreamConfig(format="parquet")
    publish(encode(items, "training"), cfg, topic)
    stream = read_stream(spark, cfg, topic)
    q = stream.writeStream.format("memory").queryName("published").trigger(availableNow=True).start()
    q.awaitTermination()
    decoded = decode(spark.table("published"), "training")
    assert decoded.where("status = 'good'").count() == items.count()


def test_kafka_is_gated(spark):
    if kafka_available(spark):
        pytest.skip("connector present")
    with pytest.raises(RuntimeError, match="connector"):
        read_stream(spark, StreamConfig(format="kafka"))


def test_config_validation(tmp_path):
    cfg = EngineConfig.from_dict({"stream": {"max_offsets_per_trigger": 3, "mode": "inference"},
                                  "train": {"hidden": [128]}, "shuffle_partitions": 2})
    assert cfg.stream.mode == "inference" and cfg.train.hidden == (128,) and cfg.shuffle_partitions == 2
    with pytest.raises(ValueError):
        EngineConfig.from_dict({"stream": {"executor_cores": 2}})
    with pytest.raises(ValueError):
        EngineConfig.from_dict({"kafka": {}})
    with pytest.raises(ValueError):
        StreamConfig(mode="other")
    p = tmp_path / "c.yaml"
    p.write_text("split:\n  seed: 7\n")
    assert EngineConfig.from_yaml(str(p)).split.seed == 7
