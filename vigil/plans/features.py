"""Fixed-shape features (OP-19, OP-23, OP-34..38, OP-42, OP-47, OP-53, OP-70, OP-71).

Modality analogues on the given tables: ``conversations`` turns are the ordered
frames of an item; lines of a document are its frames; the per-word length series of
a document stands for the fixed-length audio series; ``embeddings`` rows are text
vectors and (first ten dimensions) logits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import DEFAULT
from vigil.functions import arrays as ar
from vigil.functions import scoring as sc
from vigil.functions import text as tx
from vigil.operators.pooling import mean_pool_vector
from vigil.operators.sampling import uniform_sample
from vigil.operators.split import hash_split
from vigil.plans.catalog import query, sql_hash_split, t
from vigil.session import scratch_path
from vigil.sinks.keyed_table import KeyedTable, buckets_for, join_tables
from vigil.sources.tables import heavy_table

K_TURNS = 4  # sampled turns per conversation in the sampling check
FRAMES = DEFAULT.features.num_frames
SERIES = DEFAULT.features.series_length
WINDOW = DEFAULT.features.token_window
VEC_DIM = DEFAULT.features.text_dim  # width of the given embedding vectors


@query("uniform_sample_pad", "OP-53", f"""
WITH c AS (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
cand AS (SELECT conv_id, turn FROM c WHERE turn % greatest(n // {K_TURNS}, 1) = 0 AND turn % 5 <> 4),
r AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rk FROM cand),
kept AS (SELECT conv_id, CAST(rk - 1 AS INTEGER) AS slot, turn, false AS is_pad FROM r WHERE rk <= {K_TURNS}),
cnt AS (SELECT a.conv_id, coalesce(k.n, 0) AS n
        FROM (SELECT DISTINCT conv_id FROM conversations) a
        LEFT JOIN (SELECT conv_id, count(*) AS n FROM kept GROUP BY conv_id) k ON a.conv_id = k.conv_id)
SELECT * FROM kept
UNION ALL
SELECT cnt.conv_id, CAST(s.slot AS INTEGER) AS slot, CAST(NULL AS BIGINT) AS turn, true AS is_pad
FROM cnt, range(0, {K_TURNS}) s(slot) WHERE s.slot >= cnt.n
""")
def uniform_sample_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = t(spark, sf_dir, "conversations").select("conv_id", "turn")
    # Every fifth turn (turn % 5 = 4) stands for an unreadable frame.
    items = conv.withColumn("readable", (F.col("turn") % 5) != 4)
    sampled = uniform_sample(items, "conv_id", "turn", K_TURNS, readable="readable")
    return sampled.select("conv_id", "slot", "turn", "is_pad")


@query("pad_truncate", "OP-37", f"""
SELECT doc_id, CAST(unnest(range({SERIES})) AS INTEGER) AS pos,
       CAST(unnest(list_resize(list_transform(string_split(text, ' '), lambda w: length(w)), {SERIES}, 0))
            AS BIGINT) AS value
FROM documents
""")
def pad_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = heavy_table(spark, sf_dir, "documents", "doc_id", "text")
    series = ar.pad_truncate(tx.word_lengths("text"), SERIES, "int")
    return docs.select("doc_id", F.posexplode(series).alias("pos", "value")) \
        .withColumn("value", F.col("value").cast("long"))


@query("rescale", "OP-38", """
SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS pos,
       unnest(list_transform(embedding, lambda x: CAST(CAST(CAST(x AS DOUBLE) / 255.0 AS FLOAT) AS DOUBLE))) AS value
FROM embeddings
""")
def rescale(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return emb.select("vec_id", F.posexplode(ar.rescale("embedding")).alias("pos", "value")) \
        .withColumn("value", F.col("value").cast("double"))


@query("embedding_default", "OP-19", f"""
SELECT vec_id, CAST(CASE WHEN label % 3 = 2 THEN len(embedding) ELSE {VEC_DIM} END AS BIGINT) AS size,
       round(CASE WHEN label % 3 = 2 THEN list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) ELSE 0.0 END, 6) AS total,
       label % 3 <> 2 AS defaulted
FROM embeddings
""")
def embedding_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    # Some producers send no vector and some an empty one.
    sent = F.when(F.col("label") % 3 == 2, F.col("embedding")).when(F.col("label") % 3 == 1, F.array().cast("array<float>"))
    v = ar.default_vector(sent, VEC_DIM)
    return emb.select("vec_id", F.size(v).cast("long").alias("size"), F.round(ar.array_sum(v), 6).alias("total"),
                      (F.coalesce(F.size(sent), F.lit(0)) < 3).alias("defaulted"))


@query("vector_concat", "OP-34", """
WITH f AS (SELECT vec_id,
  list_concat(list_transform(embedding, lambda x: CAST(x AS DOUBLE)),
              list_transform(embedding, lambda x: CAST(CAST(CAST(x AS DOUBLE) / 255.0 AS FLOAT) AS DOUBLE)),
              list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS v
  FROM embeddings)
SELECT vec_id, CAST(unnest(range(len(v))) AS INTEGER) AS pos, unnest(v) AS value FROM f
""")
def vector_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fused = ar.vector_concat("embedding", ar.rescale("embedding"), "embedding")
    return emb.select("vec_id", F.posexplode(fused).alias("pos", "value")) \
        .withColumn("value", F.col("value").cast("double"))


N_CLASSES = 10  # the classes of ``embeddings.label``


def fixed_logits(vector: str) -> F.Column:
    """Logits of a linear model with fixed weights over the whole vector: the weight of
    element j for class c is ((7 j + 13 c) mod 17 - 8) / 8."""
    def logit(c: F.Column) -> F.Column:
        weighted = F.transform(F.col(vector), lambda x, j: x.cast("double") * ((j * 7 + c * 13) % 17 - 8) / F.lit(8.0))
        return F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(F.sequence(F.lit(0), F.lit(N_CLASSES - 1)), logit)


SQL_LOGITS = f"""(SELECT vec_id, label, z, list_max(z) AS m FROM
  (SELECT vec_id, label, list_transform(range({N_CLASSES}), lambda c: list_sum(list_transform(range(len(embedding)),
     lambda j: CAST(embedding[j + 1] AS DOUBLE) * ((j * 7 + c * 13) % 17 - 8) / 8.0))) AS z
   FROM embeddings))"""


@query("softmax_argmax", "OP-35 OP-36", f"""
SELECT vec_id, CAST(list_position(z, m) - 1 AS INTEGER) AS prediction,
       round(1.0 / list_sum(list_transform(z, lambda x: exp(x - m))), 6) AS p_max
FROM {SQL_LOGITS}
""")
def softmax_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    emb = emb.select("vec_id", fixed_logits("embedding").alias("logits"))
    logits = F.col("logits")
    return emb.select("vec_id", sc.argmax(logits).alias("prediction"),
                      F.round(F.array_max(sc.softmax(logits)), 6).alias("p_max"))


@query("mean_pool", "OP-42", """
SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean
FROM (SELECT label, unnest(range(len(embedding))) AS pos, unnest(embedding) AS x FROM embeddings)
GROUP BY label, pos
""")
def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings").select("label", "embedding")
    # pool whole vectors (one aggregate per key, no per-element rows before the
    # shuffle), then spread only the pooled result to (pos, mean) rows
    pooled = mean_pool_vector(emb, ["label"], "embedding")
    return pooled.select("label", F.posexplode("mean_vec").alias("pos", "mean")).withColumn(
        "mean", F.round("mean", 6))


# --- modality features on documents ---------------------------------------------------

def frame_lengths(text: str = "text", k: int = FRAMES) -> F.Column:
    """The lengths of k uniformly sampled lines, padded with zeros."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    return ar.pad_truncate(F.transform(ar.uniform_sample_array(lines, k), lambda s: F.length(s)), k, "int")


def frame_mean(text: str = "text", k: int = FRAMES) -> F.Column:
    """Lines are frames: k lines sampled uniformly, feature = line length, mean over the
    k slots (zero-padded slots count, as padded frames do). One in-row expression."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    lengths = F.transform(ar.uniform_sample_array(lines, k), lambda s: F.length(s).cast("long"))
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x) / F.lit(float(k))


def series_features(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", ar.pad_truncate(tx.word_lengths("text"), SERIES, "int").alias("series"))


def window_features(docs: DataFrame) -> DataFrame:
    toks = tx.tokens("text")
    return docs.select("doc_id", F.size(toks).cast("long").alias("n_tokens"),
                       F.least(F.size(toks), F.lit(WINDOW)).cast("long").alias("n_window"),
                       F.md5(F.concat_ws(" ", tx.token_window("text", WINDOW))).alias("window_md5"))


_SQL_FRAMES = f"""
WITH l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no,
                  unnest(string_split(text, chr(10))) AS line FROM documents),
c AS (SELECT doc_id, line_no, line, count(*) OVER (PARTITION BY doc_id) AS n FROM l),
cand AS (SELECT * FROM c WHERE line_no % greatest(n // {FRAMES}, 1) = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS rk FROM cand)
SELECT doc_id, sum(length(line)) / {float(FRAMES)} AS frame_mean FROM r WHERE rk <= {FRAMES} GROUP BY doc_id
"""


@query("modality_join", "OP-23 OP-53 OP-37 OP-42", f"""
WITH fr AS ({_SQL_FRAMES}),
se AS (SELECT doc_id, list_resize(list_transform(string_split(text, ' '), lambda w: length(w)), {SERIES}, 0) AS s
       FROM documents),
tw AS (SELECT doc_id, len(string_split(lower(text), ' ')) AS n_tokens FROM documents)
SELECT fr.doc_id, round(fr.frame_mean, 6) AS frame_mean,
       CAST(list_sum(se.s) AS BIGINT) AS series_sum, CAST(tw.n_tokens AS BIGINT) AS n_tokens,
       CAST(l.toxic AS INTEGER) AS label_idx
FROM fr JOIN se ON fr.doc_id = se.doc_id JOIN tw ON fr.doc_id = tw.doc_id LEFT JOIN labels l ON l.doc_id = fr.doc_id
""")
def modality_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three modality blocks come from one scan of the media table (row-wise
    expressions), then one join with the labels on the item key."""
    docs = heavy_table(spark, sf_dir, "documents", "doc_id", "text")
    lab = t(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label_idx"))
    series = ar.pad_truncate(tx.word_lengths("text"), SERIES, "int")
    feats = docs.select(
        "doc_id",
        F.round(frame_mean("text"), 6).alias("frame_mean"),
        F.aggregate(series, F.lit(0).cast("long"), lambda a, x: a + x).alias("series_sum"),
        F.size(tx.tokens("text")).cast("long").alias("n_tokens"))
    return feats.join(lab, "doc_id", "left").select("doc_id", "frame_mean", "series_sum", "n_tokens", "label_idx")


@query("modality_tables", "OP-23 OP-09 OP-04", f"""
WITH fr AS ({_SQL_FRAMES}),
d AS (SELECT doc_id, CAST(list_sum(list_resize(list_transform(string_split(text, ' '), lambda w: length(w)), {SERIES}, 0)) AS BIGINT) AS series_sum,
             CAST(len(string_split(lower(text), ' ')) AS BIGINT) AS n_tokens FROM documents)
SELECT d.doc_id, round(fr.frame_mean, 6) AS frame_mean, d.series_sum, d.n_tokens, CAST(l.toxic AS INTEGER) AS label_idx
FROM d LEFT JOIN fr ON fr.doc_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id
""")
def modality_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table per modality, as jobs of their own would fill them, with the same buckets: their join,
    whoever runs it and however often, has no exchange."""
    docs = heavy_table(spark, sf_dir, "documents", "doc_id", "text")
    series = ar.pad_truncate(tx.word_lengths("text"), SERIES, "int")
    blocks = {
        "series": docs.select("doc_id", F.aggregate(series, F.lit(0).cast("long"), lambda a, x: a + x).alias("series_sum")),
        "frames": docs.select("doc_id", F.round(frame_mean("text"), 6).alias("frame_mean")),
        "tokens": docs.select("doc_id", F.size(tx.tokens("text")).cast("long").alias("n_tokens")),
        "labels": t(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label_idx"))}
    buckets = buckets_for(t(spark, sf_dir, "documents"))
    tables = [KeyedTable.create(spark, scratch_path(spark, n), "doc_id", rows.schema, buckets=buckets) for n, rows in blocks.items()]
    for table, rows in zip(tables, blocks.values()):
        table.upsert(rows, 0, 0)
    return join_tables(tables).select("doc_id", "frame_mean", "series_sum", "n_tokens", "label_idx")


@query("token_window", "OP-47", f"""
SELECT doc_id, CAST(len(string_split(lower(text), ' ')) AS BIGINT) AS n_tokens,
       CAST(least(len(string_split(lower(text), ' ')), {WINDOW}) AS BIGINT) AS n_window,
       md5(array_to_string(list_resize(list_slice(string_split(lower(text), ' '), 1, {WINDOW}), {WINDOW}, ''), ' '))
         AS window_md5
FROM documents
""")
def token_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_features(heavy_table(spark, sf_dir, "documents", "doc_id", "text"))


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with labels, split, series features and a text vector (the given
    embedding of the same id, zeros when missing or too short)."""
    docs = heavy_table(spark, sf_dir, "documents", "doc_id", "text")
    lab = t(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label_idx"))
    emb = t(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    rows = hash_split(lab, "doc_id").join(series_features(docs), "doc_id").join(emb, "doc_id", "left")
    return (rows.withColumn("text_defaulted", ~F.coalesce(F.size("embedding") >= 3, F.lit(False)))
            .withColumn("text_vec", ar.default_vector("embedding", VEC_DIM)).drop("embedding"))


@query("training_set", "OP-71 OP-17 OP-19 OP-22", f"""
WITH e AS (SELECT vec_id AS doc_id, embedding FROM embeddings)
SELECT l.doc_id, CAST(l.toxic AS INTEGER) AS label_idx,
       CAST({SERIES} + CASE WHEN len(e.embedding) >= 3 THEN len(e.embedding) ELSE {VEC_DIM} END AS BIGINT)
         AS n_features,
       CAST(list_sum(list_resize(list_transform(string_split(d.text, ' '), lambda w: length(w)), {SERIES}, 0))
            AS BIGINT) AS series_sum,
       round(CASE WHEN len(e.embedding) >= 3
                  THEN list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE))) ELSE 0.0 END, 6) AS text_sum,
       coalesce(len(e.embedding) < 3, true) AS text_defaulted
FROM labels l JOIN documents d ON l.doc_id = d.doc_id LEFT JOIN e ON l.doc_id = e.doc_id
WHERE {sql_hash_split('l.doc_id')} = 'train'
""")
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(spark, sf_dir).where(F.col("split") == "train")
    return rows.select(
        "doc_id", "label_idx",
        (F.size("series") + F.size("text_vec")).cast("long").alias("n_features"),
        F.aggregate("series", F.lit(0).cast("long"), lambda a, x: a + x).alias("series_sum"),
        F.round(ar.array_sum("text_vec"), 6).alias("text_sum"),
        "text_defaulted")
