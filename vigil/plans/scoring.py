"""Closed-form models fitted, scored and evaluated relationally (OP-12, OP-65, OP-72, OP-76, OP-77).

Two models, each with an oracle that fits and scores it again in SQL:

* documents, two classes (``labels.toxic``): multinomial naive Bayes over the hashed tokens of whole texts;
* embeddings, the six classes of the application: nearest class mean of whole vectors (the given
  label modulo six is the class).

Both are fitted on the train split only and score every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import DEFAULT
from vigil.functions import arrays as ar
from vigil.functions.text import tokens
from vigil.operators import relational as rel
from vigil.operators.evaluate import class_metrics, per_class_counts
from vigil.operators.split import hash_split
from vigil.plans.catalog import SQL_CLASS_LIST, query, sql_hash_split, t
from vigil.plans.streams import PIECES
from vigil.schemas import CLASS_NAMES
from vigil.session import scratch_path
from vigil.sinks.store import read_store
from vigil.sources.tables import heavy_table
from vigil.streaming import jobs
from vigil.streaming.replay import write_pieces

# --- fixed values --------------------------------------------------------------------
DOC_CLASSES = ["normal", "offensive"]  # index = labels.toxic
# --------------------------------------------------------------------------------------
PLACES, VEC_DIM = DEFAULT.features.hash_features, DEFAULT.features.text_dim
CLASSES = len(CLASS_NAMES)


# --- documents ---------------------------------------------------------------------------------

_SQL_DOCS = f"""
WITH tf AS (
  SELECT doc_id, CAST(('0x' || substr(md5(token), 1, 8)) AS UBIGINT) % {PLACES} AS input, count(*) AS tf
  FROM (SELECT doc_id, unnest(string_split(lower(coalesce(text, '')), ' ')) AS token FROM documents) GROUP BY 1, 2),
sp AS (SELECT doc_id, toxic AS label, {sql_hash_split('doc_id')} AS split FROM documents LEFT JOIN labels USING (doc_id)),
tr AS (SELECT doc_id, label FROM sp WHERE split = 'train' AND label IS NOT NULL),
cls AS (SELECT unnest([0, 1]) AS c),
cnt AS (SELECT input, label AS c, sum(tf) AS n FROM tf JOIN tr USING (doc_id) GROUP BY 1, 2),
tot AS (SELECT c, coalesce(sum(n), 0) AS total FROM cls LEFT JOIN cnt USING (c) GROUP BY 1),
pri AS (SELECT c, ln((count(tr.doc_id) + 1) / CAST((SELECT count(*) FROM tr) + 2 AS DOUBLE)) AS w FROM cls LEFT JOIN tr ON label = c GROUP BY 1),
z AS (SELECT doc_id, c, sum(tf * (ln(coalesce(n, 0) + 1.0) - ln(total + 1.0 * {PLACES}))) AS s
      FROM tf CROSS JOIN tot LEFT JOIN cnt USING (input, c) GROUP BY 1, 2),
y AS (SELECT doc_id, max(CASE WHEN c = 0 THEN s + w END) AS z0, max(CASE WHEN c = 1 THEN s + w END) AS z1 FROM z JOIN pri USING (c) GROUP BY 1),
p AS (SELECT doc_id, CAST(CASE WHEN z1 > z0 THEN 1 ELSE 0 END AS INTEGER) AS prediction, round(1 / (1 + exp(-abs(z1 - z0))), 6) AS confidence FROM y)
"""
_SQL_PREDICTED = "SELECT doc_id, prediction, CASE prediction WHEN 0 THEN 'normal' ELSE 'offensive' END AS predicted_label, prediction = 1 AS sensitive, confidence FROM p"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text, split, label`` of every document (null when unlabelled)."""
    labels = t(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label"))
    return hash_split(heavy_table(spark, sf_dir, "documents", "doc_id", "text").join(labels, "doc_id", "left"), "doc_id")


def document_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _documents(spark, sf_dir).where("split = 'train' and label is not null")
    rows = rel.token_rows(train, "doc_id", PLACES, carry=("label",))
    weights = rel.fit_naive_bayes(rows, train, "label", PLACES, len(DOC_CLASSES))
    return rel.load(spark, rel.save(weights, scratch_path(spark, "weights")))


def _scored(docs: DataFrame, weights: DataFrame) -> DataFrame:
    return rel.predict(rel.logits(rel.token_rows(docs, "doc_id", PLACES), "doc_id", weights, len(DOC_CLASSES)), "doc_id", DOC_CLASSES)


@query("batch_score", "OP-76 OP-35 OP-36 OP-32 OP-33 OP-12", _SQL_DOCS + _SQL_PREDICTED)
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, labelled or not."""
    return _scored(heavy_table(spark, sf_dir, "documents", "doc_id", "text"), document_model(spark, sf_dir))


@query("stream_score", "OP-65 OP-76 OP-05 OP-24", _SQL_DOCS + _SQL_PREDICTED)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed features (a document's token places) arrive as files; each new micro-batch is scored
    with the saved weights and appended. The stream's checkpoint is the log of batches seen."""
    weights = document_model(spark, sf_dir)
    places = F.transform(tokens("text"), lambda w: rel.token_bucket(w, PLACES))
    landed = heavy_table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", places.alias("places"), (F.col("doc_id") % PIECES).cast("int").alias("piece"))
    src, preds, ckpt = (scratch_path(spark, n) for n in ("landed", "predictions", "ckpt"))
    files = write_pieces(landed, src, "piece", pieces=PIECES)
    stream = spark.readStream.schema("doc_id long, places array<int>, piece int").option("maxFilesPerTrigger", files).parquet(src)

    def score(batch: DataFrame) -> DataFrame:
        rows = batch.select("doc_id", F.explode_outer("places").alias("input"), F.lit(1.0).alias("value"))
        return rel.predict(rel.logits(rows, "doc_id", weights, len(DOC_CLASSES)), "doc_id", DOC_CLASSES)

    jobs.score_landed(stream, preds, ckpt, score)
    return read_store(spark, preds).select("doc_id", "prediction", "predicted_label", "sensitive", "confidence")


def _metrics(scored: DataFrame) -> DataFrame:
    out = class_metrics(per_class_counts(scored.select("label", "prediction")))
    return out.select(F.col("cls").cast("int").alias("cls"), *[F.col(c).cast("long").alias(c) for c in ("tp", "n_actual", "n_pred")],
                      *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


_SQL_METRICS = """
SELECT CAST(cls AS INTEGER) AS cls, CAST(tp AS BIGINT) AS tp, CAST(n_actual AS BIGINT) AS n_actual, CAST(n_pred AS BIGINT) AS n_pred,
       round(CASE WHEN n_pred > 0 THEN tp / CAST(n_pred AS DOUBLE) END, 6) AS precision, round(CASE WHEN n_actual > 0 THEN tp / CAST(n_actual AS DOUBLE) END, 6) AS recall,
       round(CASE WHEN tp > 0 THEN 2.0 * tp / CAST(n_pred + n_actual AS DOUBLE) END, 6) AS f1
FROM (SELECT cls, count(*) FILTER (a = cls AND b = cls) AS tp, count(*) FILTER (a = cls) AS n_actual, count(*) FILTER (b = cls) AS n_pred
      FROM e, (SELECT a AS cls FROM e UNION SELECT b FROM e) GROUP BY cls)
"""


@query("model_evaluation", "OP-77 OP-43 OP-45", _SQL_DOCS + """, e AS (
  SELECT CAST(label AS INTEGER) AS a, prediction AS b FROM p JOIN sp USING (doc_id) WHERE split = 'test' AND label IS NOT NULL)""" + _SQL_METRICS)
def model_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document model on the labelled test split: counts, precision, recall and F1 per class."""
    test = _documents(spark, sf_dir).where("split = 'test' and label is not null")
    scored = _scored(test, document_model(spark, sf_dir))
    return _metrics(scored.join(test.select("doc_id", "label"), "doc_id"))


# --- embeddings, six classes -------------------------------------------------------------------

_SQL_VECTORS = f"""
WITH v AS (SELECT vec_id, label % {CLASSES} AS label, {sql_hash_split('vec_id')} AS split, unnest(range(len(e))) AS input, unnest(e) AS value
           FROM (SELECT vec_id, label, CASE WHEN len(embedding) >= 3 THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) ELSE list_resize(CAST([] AS DOUBLE[]), {VEC_DIM}, 0.0) END AS e FROM embeddings)),
m AS (SELECT input, label AS c, avg(value) AS m FROM v WHERE split = 'train' GROUP BY 1, 2),
b AS (SELECT c, -sum(m * m) AS w FROM m GROUP BY 1),
s AS (SELECT vec_id, c, sum(2 * m * value) + any_value(b.w) AS z FROM v JOIN m USING (input) JOIN b USING (c) GROUP BY 1, 2),
p AS (SELECT vec_id, CAST(c AS INTEGER) AS prediction, round(1 / sum_e, 6) AS confidence
      FROM (SELECT *, sum(exp(z - top)) OVER (PARTITION BY vec_id) AS sum_e FROM (SELECT *, max(z) OVER (PARTITION BY vec_id) AS top FROM s))
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, c) = 1)
"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") % CLASSES).cast("int").alias("label"), ar.default_vector("embedding", VEC_DIM).alias("vector"))
    return hash_split(emb, "vec_id")


def class_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _vectors(spark, sf_dir).where("split = 'train'")
    weights = rel.fit_centroids(rel.vector_rows(train, "vec_id", "vector", ("label",)), "label", VEC_DIM, CLASSES)
    return rel.load(spark, rel.save(weights, scratch_path(spark, "weights")))


def _nearest(items: DataFrame, weights: DataFrame) -> DataFrame:
    return rel.predict(rel.logits(rel.vector_rows(items, "vec_id", "vector"), "vec_id", weights, CLASSES), "vec_id", CLASS_NAMES)


@query("six_class_score", "OP-76 OP-35 OP-36 OP-32 OP-33 OP-19", _SQL_VECTORS + f"""
SELECT vec_id, prediction, names[prediction + 1] AS predicted_label, names[prediction + 1] <> 'normal' AS sensitive, confidence
FROM (SELECT *, {SQL_CLASS_LIST} AS names FROM p)""")
def six_class_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(_vectors(spark, sf_dir), class_means(spark, sf_dir))


@query("six_class_evaluation", "OP-77 OP-43 OP-45 OP-17", _SQL_VECTORS + """, e AS (
  SELECT CAST(label AS INTEGER) AS a, prediction AS b FROM p JOIN (SELECT DISTINCT vec_id, label, split FROM v) USING (vec_id) WHERE split = 'test')""" + _SQL_METRICS)
def six_class_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = _vectors(spark, sf_dir).where("split = 'test'")
    return _metrics(_nearest(test, class_means(spark, sf_dir)).join(test.select("vec_id", "label"), "vec_id"))
