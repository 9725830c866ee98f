"""Envelope encode/decode, quarantine, manifests, paths, ids, payloads
(OP-02, OP-07, OP-08, OP-13..16, OP-30, OP-31, OP-39, OP-46)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import text as tx
from vigil.functions.arrays import array_sum, with_fallback
from vigil.functions.labels import decode_label
from vigil.operators.split import hash_split
from vigil.plans.catalog import SQL_CLASS_LIST, SQL_URL_LABEL, SQL_URL_PATH, SQL_URL_SEGS, query, sql_hash_split, t
from vigil.sinks.envelope import encode
from vigil.sources.envelope import decode
from vigil.sources.tables import heavy_table
from vigil.sources.payloads import with_payloads
from vigil.session import materialize, scratch_path
from vigil.sources.manifest import explode_documents, manifest_documents


def page_items(spark: SparkSession, sf_dir: str, cols: tuple[str, ...] = ()) -> DataFrame:
    """Pages as moderation items: id, url, label (language path segment), split."""
    pages = (heavy_table(spark, sf_dir, "pages", "page_id", "url", *cols) if cols
             else t(spark, sf_dir, "pages").select("page_id", "url"))
    path = tx.url_path("url")
    items = pages.withColumn("label", tx.path_segment(path, 1))
    return hash_split(items, "page_id")


@query("envelope_encode", "OP-08", f"""
SELECT CAST(page_id AS VARCHAR) AS id,
       to_json({{'idx': CAST(page_id AS VARCHAR), 'url': url, 'label': {SQL_URL_LABEL},
                 'split': {sql_hash_split('page_id')}}})::VARCHAR AS value
FROM pages
""")
def envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode(page_items(spark, sf_dir).withColumnRenamed("page_id", "id"), "training")
    return records.select(F.col("key").cast("string").alias("id"), F.col("value").cast("string").alias("value"))


def embedding_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = t(spark, sf_dir, "embeddings")
    items = (emb.withColumn("url", F.concat(F.lit("vec://"), F.col("vec_id").cast("string")))
             .withColumn("label", decode_label("label"))
             .withColumnRenamed("embedding", "text_embedding"))
    return hash_split(items, "vec_id")


@query("envelope_decode", "OP-13 OP-15 OP-08", f"""
SELECT CAST(vec_id AS VARCHAR) AS id, 'vec://' || CAST(vec_id AS VARCHAR) AS url,
       {SQL_CLASS_LIST}[label + 1] AS label, {sql_hash_split('vec_id')} AS split,
       'good' AS status,
       CAST(len(embedding) AS BIGINT) AS emb_size,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS emb_sum
FROM embeddings
""")
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode(embedding_items(spark, sf_dir).withColumnRenamed("vec_id", "id"), "training")
    dec = decode(records, "training")
    return dec.select("id", "url", "label", "split", "status",
                      F.size("text_embedding").cast("long").alias("emb_size"),
                      F.round(array_sum("text_embedding"), 6).alias("emb_sum"))


@query("envelope_decode_payload", "OP-14 OP-13 OP-39", """
SELECT CAST(page_id AS VARCHAR) AS id, 'good' AS status, 'ok' AS payload_status,
       CAST(strlen(html) AS BIGINT) AS payload_bytes, md5(html) AS payload_md5
FROM pages
""")
def envelope_decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = page_items(spark, sf_dir, ("html",)).withColumn(
        "video_encoded", tx.b64encode(F.encode("html", "UTF-8")))
    records = encode(items.withColumnRenamed("page_id", "id"), "inference")
    dec = decode(records, "inference")
    payload = tx.b64decode_guarded("video_encoded")
    return dec.select("id", "status", tx.payload_status("video_encoded").alias("payload_status"),
                      F.octet_length(payload).cast("long").alias("payload_bytes"),
                      F.md5(payload).alias("payload_md5"))


@query("malformed_quarantine", "OP-16 OP-13", """
SELECT CAST(event_id AS VARCHAR) AS key,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS id,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type END AS label,
       CASE WHEN event_id % 97 = 0 THEN 'quarantine' ELSE 'good' END AS status,
       CASE WHEN event_id % 97 = 0 THEN 'malformed' END AS reason
FROM events
""")
def malformed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = (t(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
          .withColumn("url", F.concat(F.lit("user://"), F.col("user_id").cast("string")))
          .withColumnRenamed("event_type", "label"))
    records = encode(ev.withColumnRenamed("event_id", "id"), "training")
    # Every 97th record is cut short in transit (corruption injected for the check; all rows kept).
    value = F.col("value").cast("string")
    cut = F.when(F.col("key").cast("string").cast("long") % 97 == 0,
                 F.expr("substring(CAST(value AS STRING), 1, length(CAST(value AS STRING)) - 1)")).otherwise(value)
    damaged = records.select("key", cut.cast("binary").alias("value"))
    dec = decode(damaged, "training", keep=["key"])
    return dec.select(F.col("key").cast("string").alias("key"), "id", "label", "status", "reason")


@query("manifest_explode", "OP-02 OP-11 OP-30", f"""
SELECT {sql_hash_split('page_id')} AS split,
       {SQL_URL_LABEL} || '_' || CAST(page_id AS VARCHAR) AS idx, url, {SQL_URL_LABEL} AS label
FROM pages
""")
def manifest_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = (page_items(spark, sf_dir)
             .withColumn("idx", F.concat_ws("_", "label", F.col("page_id").cast("string")))
             .withColumn("chunk", F.floor(F.col("page_id") / 1000)))  # bounded document size
    docs = manifest_documents(items, key="idx", split="split", chunk="chunk")
    return explode_documents(docs, carry=["split"]).select("split", "idx", "url", "label")


@query("path_parse", "OP-30", f"""
SELECT page_id,
       regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS host,
       {SQL_URL_LABEL} AS label,
       coalesce({SQL_URL_SEGS}[-1], '') AS file,
       CASE WHEN contains(coalesce({SQL_URL_SEGS}[-1], ''), '.')
            THEN regexp_extract(coalesce({SQL_URL_SEGS}[-1], ''), '^(.*)\\.[^.]*$', 1)
            ELSE coalesce({SQL_URL_SEGS}[-1], '') END AS stem,
       lower(regexp_extract(coalesce({SQL_URL_SEGS}[-1], ''), '(\\.[^.]*)$', 1)) AS ext,
       {SQL_URL_PATH} AS path
FROM pages
""")
def path_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = t(spark, sf_dir, "pages").select("page_id", "url")
    path = tx.url_path("url")
    file = tx.path_segment(path, -1)
    return pages.select("page_id", tx.url_host("url").alias("host"), tx.path_segment(path, 1).alias("label"),
                        file.alias("file"), tx.file_stem(file).alias("stem"), tx.file_ext(file).alias("ext"),
                        path.alias("path"))


@query("stable_id", "OP-31", f"""
SELECT page_id, {sql_hash_split('page_id')} AS split,
       sha256({sql_hash_split('page_id')} || ':' || url) AS id
FROM pages
""")
def stable_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = hash_split(t(spark, sf_dir, "pages").select("page_id", "url"), "page_id")
    return items.select("page_id", "split", tx.stable_id("split", "url").alias("id"))


@query("payload_encode", "OP-07 OP-39", """
SELECT page_id, CASE WHEN strlen(html) = 0 THEN 'empty' ELSE 'ok' END AS payload_status,
       CAST(length(to_base64(encode(html))) AS BIGINT) AS payload_len,
       md5(to_base64(encode(html))) AS payload_md5
FROM pages
""")
def payload_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = heavy_table(spark, sf_dir, "pages", "page_id", "html")
    b64 = tx.b64encode(F.encode("html", "UTF-8"))
    return pages.select("page_id",
                        F.when(F.length("html") == 0, "empty").otherwise("ok").alias("payload_status"),
                        F.length(b64).cast("long").alias("payload_len"), F.md5(b64).alias("payload_md5"))


def damaged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base64 payloads of pages, with deterministic damage injected for the guard
    checks (every 11th empty, the next one prefixed with an invalid character)."""
    pages = heavy_table(spark, sf_dir, "pages", "page_id", "html")
    b64 = tx.b64encode(F.encode("html", "UTF-8"))
    r = F.col("page_id") % 11
    payload = F.when(r == 0, F.lit("")).when(r == 1, F.concat(F.lit("!"), b64)).otherwise(b64)
    return pages.select("page_id", payload.alias("payload"))


_GUARD_STATUS = "CASE WHEN page_id % 11 = 0 THEN 'empty' WHEN page_id % 11 = 1 THEN 'decode_error' ELSE 'ok' END"


@query("payload_decode_guard", "OP-39", f"""
SELECT page_id, {_GUARD_STATUS} AS status,
       CASE WHEN page_id % 11 > 1 THEN CAST(strlen(html) AS BIGINT) END AS payload_bytes,
       CASE WHEN page_id % 11 > 1 THEN md5(html) END AS payload_md5
FROM pages
""")
def payload_decode_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = damaged_payloads(spark, sf_dir)
    raw = tx.b64decode_guarded("payload")
    ok = tx.payload_status("payload")
    data = F.when(ok == "ok", raw)
    return p.select("page_id", ok.alias("status"), F.octet_length(data).cast("long").alias("payload_bytes"),
                    F.md5(data).alias("payload_md5"))


@query("feature_fallback", "OP-46 OP-39", f"""
SELECT page_id, {_GUARD_STATUS} AS status,
       CASE WHEN page_id % 11 > 1 THEN CAST(strlen(html) AS DOUBLE) ELSE 0.0 END AS n_bytes,
       CASE WHEN page_id % 11 > 1 THEN CAST(len(string_split(html, chr(10))) AS DOUBLE) ELSE 0.0 END AS n_lines,
       CASE WHEN page_id % 11 > 1 THEN CAST(length(html) - length(replace(html, '<', '')) AS DOUBLE)
            ELSE 0.0 END AS n_tags
FROM pages
""")
def feature_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = damaged_payloads(spark, sf_dir)
    status = tx.payload_status("payload")
    body = F.when(status == "ok", tx.b64decode_guarded("payload")).cast("string")
    feat = F.when(body.isNotNull(), F.array(
        F.octet_length(body).cast("double"),
        F.size(F.split(body, "\n")).cast("double"),
        (F.length(body) - F.length(F.replace(body, F.lit("<"), F.lit("")))).cast("double")))
    vec = with_fallback(feat, 3)
    return p.select("page_id", status.alias("status"), F.get(vec, 0).alias("n_bytes"),
                    F.get(vec, 1).alias("n_lines"), F.get(vec, 2).alias("n_tags"))


@query("manifest_records", "OP-02 OP-31 OP-08 OP-13", f"""
SELECT sha256({sql_hash_split('page_id')} || ':' || url) AS id, url, {SQL_URL_LABEL} AS label,
       {sql_hash_split('page_id')} AS split, 'good' AS status
FROM pages
""")
def manifest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer path: manifest rows -> stable-id envelope records -> decoded again."""
    from vigil.streaming.producer import manifest_to_records

    manifest = page_items(spark, sf_dir).select("url", "label", F.col("split").alias("flag"))
    records = manifest_to_records(spark, manifest, "training")
    return decode(records, "training").select("id", "url", "label", "split", "status")


@query("payload_fetch", "OP-07 OP-02 OP-03", """
SELECT page_id, CASE WHEN page_id % 10 = 3 THEN 'missing' WHEN page_id % 10 = 5 THEN 'unreadable' WHEN page_id % 10 = 6 OR coalesce(html, '') = '' THEN 'empty' ELSE 'ok' END AS payload_status,
       CASE WHEN page_id % 10 NOT IN (3, 5, 6) AND html <> '' THEN CAST(strlen(html) AS BIGINT) END AS n_bytes,
       CASE WHEN page_id % 10 NOT IN (3, 5, 6) AND html <> '' THEN md5(html) END AS content_md5
FROM pages
""")
def payload_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is written as a file of its own; some are left out, some are empty, at some paths there is a folder. All are
    wanted, and fetched by path in ranges of 4,096 bytes, so that long pages are put together from several."""
    folder = scratch_path(spark, "media")
    pages = heavy_table(spark, sf_dir, "pages", "page_id", "html")
    kind = F.when(F.col("page_id") % 10 == 3, "none").when(F.col("page_id") % 10 == 5, "folder").otherwise("file")
    body = F.when(F.col("page_id") % 10 == 6, "").otherwise(F.coalesce("html", F.lit("")))
    url = F.concat(F.lit(folder + "/"), F.col("page_id").cast("string"), F.lit(".html"))
    items = pages.select("page_id", url.alias("url"), kind.alias("kind"), F.encode(body, "UTF-8").alias("content"))
    written = materialize(items.mapInArrow(write_files, "page_id long, url string"), "manifest")
    got = with_payloads(spark, written, range_bytes=4096)
    return got.select("page_id", "payload_status", F.octet_length("content").cast("long").alias("n_bytes"), F.md5("content").alias("content_md5"))


def write_files(batches):
    """Files and folders named by ``url`` and ``kind`` (``none``: neither), by ``content``."""
    import pyarrow as pa

    from vigil.sources.payloads import _opened

    for batch in batches:
        for r in batch.to_pylist():
            system, path = _opened(r["url"])
            if r["kind"] == "folder":
                system.create_dir(path, recursive=True)
            elif r["kind"] == "file":
                system.create_dir(path.rpartition("/")[0], recursive=True)
                with system.open_output_stream(path, compression=None) as out:
                    out.write(r["content"])
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url")], names=["page_id", "url"])
