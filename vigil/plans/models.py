"""Featurize, text vectors, training with early stopping, model selection and scoring by a
network (OP-12, OP-47, OP-70..74, OP-76).

Documents are the items; ``labels.toxic`` is the class (0 normal, 1 offensive). The
modalities, a tower each: sampled line lengths (30), word-length series (40), text vector (the given
embedding of the same id, zeros when missing), hashed TF-IDF of the whole text.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import DEFAULT
from vigil.functions import arrays as ar
from vigil.operators import towers
from vigil.operators import training as tr
from vigil.operators.contained import contained
from vigil.operators.featurize import Extractor, composed_text, featurize as run_extractors
from vigil.operators.relational import token_places
from vigil.operators.split import hash_split
from vigil.plans.catalog import query, t
from vigil.sources.tables import heavy_table
from vigil.functions.text import word_lengths
from vigil.plans.features import FRAMES, SERIES, VEC_DIM, _SQL_FRAMES, frame_lengths, frame_mean
from vigil.session import checkpoint_root, materialize, scratch_path
from vigil.streaming import jobs

# --- fixed values --------------------------------------------------------------------
DOC_CLASSES = ["normal", "offensive"]  # index = labels.toxic
# --------------------------------------------------------------------------------------
TEXT_HASH = DEFAULT.features.hash_features
TRAIN = DEFAULT.train
WIDTHS = {"frames": FRAMES, "series": SERIES, "text": VEC_DIM, "tokens": TEXT_HASH}


@query("featurize", "OP-70 OP-46 OP-53 OP-37", f"""
WITH fr AS ({_SQL_FRAMES})
SELECT d.doc_id, 'ok' AS status, round(fr.frame_mean, 6) AS frame_mean,
       CAST(CAST(length(nfc_normalize(d.text)) AS FLOAT) AS BIGINT) AS n_composed,  -- features are stored as float32
       CAST(list_sum(list_resize(list_transform(string_split(d.text, ' '), lambda w: length(w)), {SERIES}, 0))
            AS BIGINT) AS series_sum
FROM documents d JOIN fr ON d.doc_id = fr.doc_id
""")
def featurize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = heavy_table(spark, sf_dir, "documents", "doc_id", "text")
    series = ar.pad_truncate(word_lengths("text"), SERIES, "int")
    docs = docs.select("doc_id", "text", F.round(frame_mean("text"), 6).alias("frame_mean"),
                       F.aggregate(series, F.lit(0).cast("long"), lambda a, x: a + x).alias("series_sum"))
    feats = run_extractors(docs, "doc_id", "text", [composed_text()], carry=["frame_mean", "series_sum"])
    return feats.select("doc_id", "status", "frame_mean", F.get("composed", 0).cast("long").alias("n_composed"), "series_sum")


# --- fixed values: what a spoiled text starts with, and what becomes of it ------------
SPOILED = {"kill": "killed by signal 9", "hang": "no answer in 2 s", "fail": "spoiled"}
# --------------------------------------------------------------------------------------
_SQL_SPOILED = "CASE WHEN doc_id % 100 = 7 THEN 'kill' WHEN doc_id % 500 = 9 THEN 'hang' WHEN doc_id % 50 = 3 THEN 'fail' END"


def spoiled_text() -> Extractor:
    """``composed_text`` as a codec that dies of, hangs on or refuses the texts that are marked so."""
    def init():
        import os
        import time

        count = composed_text().init()

        def extract(text: str) -> list[int]:
            if text.startswith("\x00kill"):
                os.kill(os.getpid(), 9)
            if text.startswith("\x00hang"):
                time.sleep(3600)
            if text.startswith("\x00fail"):
                raise ValueError("spoiled")
            return count(text)
        return extract
    return Extractor("composed", 1, init)


@query("featurize_contained", "OP-70 OP-46", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_SQL_SPOILED} AS spoiled FROM documents)
SELECT doc_id, CASE WHEN spoiled IS NULL THEN 'ok' ELSE 'fallback' END AS status,
       CASE spoiled {' '.join(f"WHEN '{k}' THEN 'composed: {v}'" for k, v in SPOILED.items())} END AS error,
       CASE WHEN spoiled IS NULL THEN CAST(CAST(length(nfc_normalize(text)) AS FLOAT) AS BIGINT) ELSE 0 END AS n_composed
FROM d
""")
def featurize_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some texts are marked as spoiled: the extractor is killed by them, hangs on them, or raises an error. Every other
    text still gets its features, and each of those a row with its reason."""
    docs = heavy_table(spark, sf_dir, "documents", "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    marked = F.coalesce(F.concat(F.lit("\x00"), F.expr(_SQL_SPOILED), text), text)
    feats = run_extractors(docs.select("doc_id", marked.alias("text")), "doc_id", "text", [contained(spoiled_text(), seconds=2)])
    return feats.select("doc_id", "status", "error", F.get("composed", 0).cast("long").alias("n_composed"))


@query("text_features", "OP-47", f"""
WITH k AS (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS token FROM documents),
tf AS (SELECT doc_id, CAST(('0x' || substr(md5(token), 1, 8)) AS UBIGINT) % {TEXT_HASH} AS bucket, count(*) AS tf FROM k GROUP BY 1, 2),
df AS (SELECT bucket, ln(((SELECT count(*) FROM documents) + 1) / CAST(count(*) + 1 AS DOUBLE)) AS idf FROM tf GROUP BY 1)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_buckets, CAST(sum(tf) AS BIGINT) AS n_tokens, round(sum(tf * idf), 4) AS weight_sum
FROM tf JOIN df USING (bucket) GROUP BY doc_id
""")
def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.token_weights(heavy_table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", num_features=TEXT_HASH)


def model_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document once: ``doc_id, split, label`` (null when unlabelled) and the blocks ``frames``,
    ``series``, ``text`` (the embedding of the same id, zeros when missing) and ``tokens`` (places of
    the whole text's tokens). One pass over the texts."""
    docs = heavy_table(spark, sf_dir, "documents", "doc_id", "text")
    docs = hash_split(docs, "doc_id").select(
        "doc_id", "split", F.transform(frame_lengths("text"), lambda x: x.cast("double")).alias("frames"),
        F.transform(ar.pad_truncate(word_lengths("text", SERIES), SERIES, "int"), lambda x: x.cast("double")).alias("series"),
        token_places("text", TEXT_HASH).alias("tokens"))
    lab = t(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label"))
    emb = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    vector = ar.pad_truncate(ar.default_vector("embedding", VEC_DIM), VEC_DIM, "double")
    return docs.join(lab, "doc_id", "left").join(emb, "doc_id", "left").withColumn("text", vector).drop("embedding")


@dataclass(frozen=True)
class Trained:
    """What a training left in the shared folder."""
    features: DataFrame  # every document: ``doc_id, split, label`` and the blocks
    models: dict[str, towers.Fitted]  # by preset
    path: str  # of the training of ``fusion``

    @property
    def model(self) -> towers.Fitted:
        return self.models["fusion"]


def _place(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the models learnt from exactly these input files in this application."""
    files = sorted(f for name in ("documents", "labels", "embeddings") for f in t(spark, sf_dir, name).inputFiles())
    seen = "|".join(f"{f}:{jobs.file_state(spark, f)}" for f in files)
    print_ = hashlib.sha256(f"{spark.sparkContext.applicationId}|{TRAIN}|{TEXT_HASH}|{seen}".encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark)}/vigil/models-{print_}"


def fit_presets(features: DataFrame, paths: dict[str, str]) -> dict[str, towers.Fitted]:
    """Each preset of ``paths`` is fitted in its folder, all at the same time: their stages share the free slots, and
    none waits for another's validation. Labelled rows are written and described once, as every epoch reads them."""
    labelled = features.where("label is not null")
    train = materialize(towers.weighted(labelled.where("split = 'train'")), "train_rows")
    val = materialize(labelled.where("split = 'val'"), "val_rows")
    spec = towers.describe(train, next(iter(paths)), WIDTHS, len(DOC_CLASSES))

    def fit(preset: str) -> towers.Fitted:
        return towers.fit(train, val, "doc_id", replace(spec, preset=preset), TRAIN, paths[preset])
    with ThreadPoolExecutor(len(paths)) as pool:
        return dict(zip(paths, pool.map(inheritable_thread_target(features.sparkSession)(fit), paths)))


def train_models(spark: SparkSession, sf_dir: str, presets: tuple[str, ...] = ("fusion",)) -> Trained:
    """Train from scratch; features and the best state are saved, and the paths of those and of ``fusion`` noted where
    ``trained`` finds them."""
    features, paths = scratch_path(spark, "model_features"), {p: scratch_path(spark, "model") for p in presets}
    model_inputs(spark, sf_dir).write.parquet(features)
    rows = spark.read.parquet(features)
    fitted = fit_presets(rows, paths)
    jobs.write_text(spark, _place(spark, sf_dir), f"{features}|{paths['fusion']}")
    return Trained(rows, fitted, paths["fusion"])


def trained(spark: SparkSession, sf_dir: str, presets: tuple[str, ...] = ("fusion",)) -> Trained:
    """The presets, ``fusion`` among them, fitted on these very input files. Of an earlier training the features and
    ``fusion`` are read; without one all are made."""
    noted = jobs.read_text(spark, _place(spark, sf_dir))
    if noted is None:
        return train_models(spark, sf_dir, presets)
    features, model = noted.split("|")
    rows, others = spark.read.parquet(features), {p: scratch_path(spark, "model") for p in presets if p != "fusion"}
    return Trained(rows, {"fusion": towers.load(spark, model)} | (fit_presets(rows, others) if others else {}), model)


def _history(spark: SparkSession, fitted: towers.Fitted) -> DataFrame:
    rows = [(h["epoch"], h["train_loss"], h["val_log_loss"], h["val_accuracy"], h["val_macro_f1"], h["improved"]) for h in fitted.history]
    return spark.createDataFrame(rows, "epoch int, train_loss double, val_log_loss double, val_accuracy double, val_macro_f1 double, improved boolean")


@query("train_early_stop", "OP-72 OP-74 OP-12 OP-71")
def train_early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, train_models(spark, sf_dir).model)


@query("model_selection", "OP-73 OP-72")
def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three presets, fitted on the same features; the best macro-F1 on the validation split is selected."""
    found = trained(spark, sf_dir, ("fusion", "tiny", "simple")).models
    rows = [(name, max((h for h in m.history if h["improved"]), key=lambda h: h["epoch"])) for name, m in found.items()]
    best = max(rows, key=lambda r: r[1]["val_macro_f1"])[0]
    return spark.createDataFrame([(n, h["val_log_loss"], h["val_accuracy"], h["val_macro_f1"], n == best) for n, h in rows],
                                 "model string, val_log_loss double, val_accuracy double, val_macro_f1 double, selected boolean")


@query("external_score", "OP-76 OP-35 OP-36 OP-32 OP-33")
def external_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document with the network: numpy in Arrow batches; softmax, argmax, label name and
    sensitive flag are built-in expressions."""
    found = trained(spark, sf_dir)
    return towers.score(found.features, found.model, DOC_CLASSES, ("doc_id",))
