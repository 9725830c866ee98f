"""The queries of this folder: thin, one per operator, over the whole intended table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.sources.tables import table

QUERIES, ORACLES = {}, {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80).withColumnRenamed("id", "doc_id")


ORACLES["op4_minhash_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:least(i + 3, len(ws))], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
fp AS (SELECT doc_id, md5(string_agg(g, ',' ORDER BY g)) AS f FROM s GROUP BY 1),
cls AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY f) AS rep FROM fp),
r AS (SELECT s.doc_id, s.g FROM s JOIN cls USING (doc_id) WHERE cls.rep = s.doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM r x JOIN r y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
  UNION ALL SELECT rep, doc_id FROM cls WHERE rep <> doc_id),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON reach.b = l.a),
comp AS (SELECT a AS doc_id, least(a, min(b)) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.c, d.doc_id) AS component_id,
       d.doc_id = coalesce(comp.c, d.doc_id) AS kept
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""


@_query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm.license_scan import scan

    found = scan(table(spark, sf_dir, "documents"))
    return found.drop("detections").withColumnRenamed("id", "doc_id")


@_query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm.toxicity import may_learn, score, train_on

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train_on(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), (~may_learn("id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm import pii

    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.train(docs))
    base = F.filter("found", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS[:4])]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(pii.written(base).cast("binary"), 256).alias("base_sha256"),
                        pii.written(F.col("found")).alias("spans"))


@_query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm.decontaminate import find

    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# every window that holds a shingle of an item, compared exactly
ORACLES["op9_decontamination"] = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w FROM benchmark),
it AS (SELECT item_id, w, least(5, len(w)) AS k, len(w) - least(5, len(w)) + 1 AS m FROM iw WHERE len(w) > 0),
ish AS (SELECT item_id, k, m, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM it)),
ic AS (SELECT item_id, k, m, g, count(*) AS c FROM ish GROUP BY ALL),
dsh AS (SELECT doc_id, k, n, i - 1 AS p, array_to_string(w[i:i + k - 1], ' ') AS g
        FROM (SELECT doc_id, w, k, len(w) - k + 1 AS n, unnest(range(1, len(w) - k + 2)) AS i
              FROM dw, (SELECT DISTINCT k FROM it) WHERE len(w) >= k)),
starts AS (SELECT DISTINCT doc_id, item_id, k, m, least(m, n) AS size,
                  unnest(range(greatest(p - least(m, n) + 1, 0), least(p, n - least(m, n)) + 1)) AS s
           FROM dsh JOIN ic USING (k, g)),
wc AS (SELECT doc_id, item_id, k, m, size, s, g, count(*) AS c FROM starts JOIN dsh USING (doc_id, k) WHERE p >= s AND p < s + size GROUP BY ALL),
sim AS (SELECT doc_id, item_id, k, wc.m, size, s, sum(least(wc.c, ic.c)) AS shared FROM wc JOIN ic USING (item_id, k, g) GROUP BY ALL),
ok AS (SELECT doc_id, item_id, CAST(shared AS DOUBLE) / CAST(size + m - shared AS DOUBLE) AS similarity, s, size + k - 1 AS n_words FROM sim)
SELECT doc_id, item_id, similarity, CAST(s AS BIGINT) AS first_word, CAST(n_words AS BIGINT) AS n_words FROM ok WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) = 1
"""


@_query
def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from vigil.llm import wavelet

    shards = wavelet.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return wavelet.read(shards).withColumnRenamed("id", "doc_id")


@_query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm import warc
    from vigil.session import materialize

    archives = warc.write(table(spark, sf_dir, "pages"))
    read = materialize(warc.read(archives).drop("payload", "url"), "records")
    return warc.with_referred(read).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op2_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""


@_query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from vigil.llm import chat
    from vigil.session import materialize

    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(more)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chat.read_chats(materialize(chat.format_chats(rows, path), "chats"), path)


ORACLES["op8_chat_format"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + 10 + 10 + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
                + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


@_query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from vigil.llm.sentence_pieces import encode

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


@_query
def op1_hnsw_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm.hnsw import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


ORACLES["op1_hnsw_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS vec_id, least(a, min(b)) AS c FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT t.vec_id, coalesce(n.n, 0) AS n_links, coalesce(comp.c, t.vec_id) AS component_id, t.vec_id = coalesce(comp.c, t.vec_id) AS kept
FROM embeddings t LEFT JOIN comp USING (vec_id) LEFT JOIN n USING (vec_id)
"""


@_query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents),
f AS (SELECT doc_id, part,
             CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * list_unique(w) < 80 * len(w) THEN 2 ELSE 0 END
             + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
             + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN first < doc_id THEN 16 ELSE 0 END AS fails FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
st AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM o),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, CAST(1 << (ascii(filter_order[step]) - 65) AS INTEGER) AS bit,
             list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS before_sum FROM st),
g AS (SELECT part, filter_order, step, bit,
             sum(CASE WHEN fails & (bit | coalesce(before_sum, 0)::INTEGER) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fails & bit <> 0 AND fails & coalesce(before_sum, 0)::INTEGER = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN fails & bit <> 0 AND fails & coalesce(before_sum, 0)::INTEGER <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN fails & bit <> 0 AND fails & coalesce(before_sum, 0)::INTEGER = 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails & bit <> 0 AND fails & coalesce(before_sum, 0)::INTEGER = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM m, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM g
"""


@_query
def op12_geometric_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm.geometric_kmeans import cluster

    return cluster(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def _kmeans_sql(rounds: int, k: int) -> str:
    """Every round as its own query: all distances, sums by component, floors."""
    near = """a{r} AS MATERIALIZED (SELECT v.n, v.vec_id, v.e, c.c, c.e AS ce, list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
FROM v, c{r} c QUALIFY row_number() OVER (PARTITION BY v.n ORDER BY d, c.c) = 1)"""
    move = """c{s} AS MATERIALIZED (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
  SELECT c, list(f ORDER BY i) AS e FROM (SELECT c, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS f
    FROM (SELECT c, unnest(e) AS x, unnest(range(len(e))) AS i FROM a{r}) GROUP BY c, i) GROUP BY c) m USING (c))"""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, e) - 1 AS c, e FROM v QUALIFY c < {k})"""]
    for r in range(rounds):
        parts += [near.format(r=r), move.format(r=r, s=r + 1)]
    parts.append(near.format(r=rounds))
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(ce, ',')) AS centroid_sha256 FROM a{rounds}"""


ORACLES["op12_geometric_kmeans"] = _kmeans_sql(10, 8)


@_query
def op13_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vigil.llm.digest_index import deduplicate

    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op13_digest_index"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
