"""Each program end to end on file streams: publish, ingest, train, land, score."""

import json
import os

import pytest
from pyspark.sql import functions as F

from vigil import jobs
from vigil.sinks.keyed_table import KeyedTable
from vigil.sinks.store import read_store


def test_all_jobs_end_to_end(spark, scratch):
    place = {n: scratch(n).replace("file:", "") for n in ("manifest", "media", "topic", "store", "ck1", "landing", "ck2", "model", "pred", "ck3", "table")}
    os.makedirs(place["manifest"])
    manifest = {}
    for i in range(60):
        label = "violent" if i % 2 else "normal"
        os.makedirs(f"{place['media']}/{label}", exist_ok=True)
        url = f"{place['media']}/{label}/{i:04d}.mp4"
        if i != 7:  # one media file is missing
            with open(url, "w") as f:
                f.write(("punch " if i % 2 else "a bb ccc ") * (5 + i % 3))
        manifest[f"{label}_{i}"] = {"url": url, "label": label, "text_embedding": [float(i % 2)] * 8, "flag": "val" if i % 5 == 0 else "train"}
    with open(f"{place['manifest']}/part.json", "w") as f:
        json.dump(manifest, f)
    base = {"stream": {"format": "parquet", "mode": "inference"}, "features": {"text_dim": 8, "series_length": 10},
            "train": {"max_rounds": 4, "iters_per_round": 10, "hidden": [8]}}

    jobs.run("publish", base | {"job": {"source": place["manifest"], "target": place["topic"], "media": place["media"]}}, spark)
    spark.createDataFrame([(b"k", b"junk")], "key binary, value binary").write.mode("append").parquet(place["topic"])
    jobs.run("ingest", base | {"job": {"source": place["topic"], "target": place["store"], "checkpoint": place["ck1"], "strategy": "payload"}}, spark)
    store = KeyedTable.open(spark, place["store"]).current()
    assert store.count() == 60 and store.where("status = 'ok'").count() == 59
    assert store.where("status <> 'ok'").select(F.array_max("series")).first()[0] == 0
    assert read_store(spark, place["store"] + "_quarantine").count() == 1

    jobs.run("compact", base | {"job": {"source": place["store"]}}, spark)
    assert sorted(r.id for r in KeyedTable.open(spark, place["store"]).current().collect()) == sorted(r.id for r in store.select("id").collect())

    jobs.run("train", base | {"job": {"source": place["store"], "target": place["model"]}}, spark)
    text = F.when(F.col("label") == "violent", F.repeat(F.lit("punch "), 5)).otherwise(F.repeat(F.lit("a bb ccc "), 5))
    store.where("url not like '%0001%'").select("id", text.alias("text")).write.parquet(place["table"])
    jobs.run("land", base | {"job": {"source": place["topic"], "target": place["landing"], "checkpoint": place["ck2"], "media": place["table"]}}, spark)
    landed = read_store(spark, place["landing"])
    assert landed.count() == 60 and landed.where("status = 'missing'").count() == 1
    jobs.run("score", base | {"job": {"source": place["landing"], "target": place["pred"], "checkpoint": place["ck3"], "model": place["model"]}}, spark)
    scored = read_store(spark, place["pred"]).join(store.select("id", "label"), "id").select("label", "predicted_label").collect()
    assert len(scored) == 60 and sum(r.label == r.predicted_label for r in scored) >= 55


def test_configs_are_checked(spark):
    with pytest.raises(ValueError):
        jobs.run("ingest", {"job": {"sink": "x"}}, spark)
    with pytest.raises(ValueError):
        jobs.run("ingest", {"job": {"strategy": "neither"}}, spark)
    with pytest.raises(ValueError):
        jobs.run("score", {"job": {"source": "x"}}, spark)
