"""Literal semantics cases (expected values listed in FIXTURES.md)."""

import math

import pytest
from pyspark.sql import functions as F

from vigil.functions import arrays as ar
from vigil.functions import scoring as sc
from vigil.functions import text as tx
from vigil.functions.labels import decode_label, encode_label, encode_with_dimension, sensitive_flag
from vigil.operators.sampling import uniform_sample
from vigil.operators.split import exact_split, split_sizes
from vigil.operators.upsert import current_view, dedupe_in_batch
from vigil.sources.envelope import decode


def test_decode_and_quarantine(spark):
    sender = ('{"label":"x","video_name":"a.mp4","video_path":"/p/a.mp4","video_data":"AA==",'
              '"text_embedding":[0.0,0.0]}')
    rows = [('{"idx":"a","text_embedding":[1,2]}',), ("junk",), ('{"x":1}',), (sender,),
            ('{"idx":5,"text_embedding":"no"}',)]
    df = spark.createDataFrame(rows, "value string")
    out = {r["value"]: r for r in decode(df, keep=["value"]).collect()}
    a = out[rows[0][0]]
    assert (a.id, a.text_embedding, a.status, a.url) == ("a", [1.0, 2.0], "good", None)
    assert out["junk"].status == "quarantine" and out["junk"].reason == "malformed"
    assert out['{"x":1}'].status == "quarantine" and out['{"x":1}'].reason == "missing_id"
    assert out[sender].status == "quarantine" and out[sender].id is None
    five = out[rows[4][0]]
    assert (five.id, five.text_embedding, five.status) == ("5", None, "good")
    vec = spark.createDataFrame([(None,)], "v array<float>").select(ar.default_vector("v", 4).alias("d")).first().d
    assert vec == [0.0] * 4


SAMPLING = [  # n, k, unreadable, kept positions, padding
    (0, 4, None, [], 4), (3, 4, None, [0, 1, 2], 1), (7, 4, None, [0, 1, 2, 3], 0),
    (8, 4, None, [0, 2, 4, 6], 0), (9, 4, None, [0, 2, 4, 6], 0), (8, 4, 4, [0, 2, 6], 1),
    (9, 4, 0, [2, 4, 6, 8], 0), (5, 4, 1, [0, 2, 3, 4], 0), (59, 30, None, list(range(30)), 0),
    (100, 30, None, list(range(0, 88, 3)), 0),
]


@pytest.mark.parametrize("n,k,bad,kept,pad", SAMPLING)
def test_uniform_sampling_of_arrays(spark, n, k, bad, kept, pad):
    items = spark.range(1).select(F.array(*[F.lit(i) for i in range(n)]).cast("array<int>").alias("a"))
    readable = None if bad is None else (lambda item, pos: pos != bad)
    got = items.select(ar.uniform_sample_array("a", k, readable).alias("s")).first().s
    assert got == kept and k - len(got) == pad


def test_uniform_sampling_spark(spark):
    items, keys = [], []
    for seq, (n, k, bad, kept, pad) in enumerate(SAMPLING):
        keys.append((seq,))
        items += [(seq, p, p != bad) for p in range(n)]
    df = spark.createDataFrame(items, "seq long, pos long, ok boolean")
    # k differs per case; run each k separately
    for k in sorted({c[1] for c in SAMPLING}):
        ids = [i for i, c in enumerate(SAMPLING) if c[1] == k]
        sub = df.where(F.col("seq").isin(ids))
        key_df = spark.createDataFrame([(i,) for i in ids], "seq long")
        res = uniform_sample(sub, "seq", "pos", k, readable="ok", keys=key_df).collect()
        for i in ids:
            _, _, _, kept, pad = SAMPLING[i]
            mine = sorted((r.slot, r.pos, r.is_pad) for r in res if r.seq == i)
            assert [p for _, p, is_pad in mine if not is_pad] == kept
            assert sum(1 for *_, is_pad in mine if is_pad) == pad
            assert [s for s, _, _ in mine] == list(range(k))


@pytest.mark.parametrize("n,sizes", [(7, (4, 1, 2)), (10, (7, 1, 2)), (20, (14, 3, 3)), (203, (142, 30, 31)),
                                     (1000, (700, 150, 150))])
def test_split_sizes(spark, n, sizes):
    assert split_sizes(n) == sizes
    got = exact_split(spark.range(n).withColumnRenamed("id", "key"), "key").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {s: c for s, c in zip(("train", "val", "test"), sizes) if c}


def test_exact_split_matches_global_order(spark):
    from pyspark.sql import Window

    df = spark.range(5000).withColumnRenamed("id", "key")
    mine = {r.key: r.split for r in exact_split(df, "key").collect()}
    h = F.md5(F.concat_ws(":", F.lit("42"), F.col("key").cast("string")))
    ref = df.withColumn("pos", F.row_number().over(Window.orderBy(h, "key")) - 1).collect()
    n_train, n_val, _ = split_sizes(5000)
    for r in ref:
        want = "train" if r.pos < n_train else ("val" if r.pos < n_train + n_val else "test")
        assert mine[r.key] == want


def test_labels(spark):
    df = spark.createDataFrame([("horrible",), ("normal",), ("violent",), ("superstitious",), ("cat",), (None,)],
                               "label string")
    got = [r.i for r in df.select(encode_label("label").alias("i")).collect()]
    assert got == [0, 1, 5, 4, -1, -1]
    idx = spark.createDataFrame([(0,), (5,), (-1,), (6,), (None,)], "i int")
    assert [r.n for r in idx.select(decode_label("i").alias("n")).collect()] == \
        ["horrible", "violent", None, None, None]
    flags = df.select(sensitive_flag("label").alias("s")).collect()
    assert [r.s for r in flags] == [True, False, True, True, False, False]


def test_pad_truncate_and_default(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0, 4.0, 5.0],), ([],)], "v array<float>")
    assert [r.p for r in df.select(ar.pad_truncate("v", 4).alias("p")).collect()] == \
        [[1, 2, 0, 0], [1, 2, 3, 4], [0, 0, 0, 0]]
    df2 = spark.createDataFrame([([],), ([1.0],), ([1.0, 2.0],), ([1.0, 2.0, 3.0],)], "v array<float>")
    assert [r.d for r in df2.select(ar.default_vector("v", 3).alias("d")).collect()] == \
        [[0, 0, 0], [0, 0, 0], [0, 0, 0], [1, 2, 3]]
    r = spark.createDataFrame([([255.0, 51.0],)], "v array<float>").select(ar.rescale("v").alias("r")).first().r
    assert r == pytest.approx([1.0, 0.2])


def test_softmax_argmax_cross_entropy(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0, 3.0],)], "z array<double>")
    r = df.select(sc.softmax("z").alias("p"), sc.argmax("z").alias("a"), sc.cross_entropy("z", F.lit(1)).alias("c1"),
                  sc.cross_entropy("z", F.lit(2)).alias("c2")).first()
    assert r.p == pytest.approx([0.054065, 0.399486, 0.146963, 0.399486], abs=1e-6)
    assert r.a == 1
    assert r.c1 == pytest.approx(0.917576, abs=1e-6) and r.c2 == pytest.approx(1.917576, abs=1e-6)
    assert math.isclose(sum(r.p), 1.0)


def test_stable_id(spark):
    df = spark.createDataFrame([("val", "/data/val/horrible/0003.mp4"), ("test", "/data/test/horrible/0003.mp4")],
                               "split string, url string")
    got = [r.i for r in df.select(tx.stable_id("split", "url").alias("i")).collect()]
    assert got == ["8533b7609203c7965b6683cb62d53ce4b3d2a61ba320337f406a1e0a438e899b",
                   "a22f63d32c2d02758ac074f7ce95b13fe50a0988650eb4593ed8c3b79acf2b8a"]


def test_upsert_last_write_wins(spark):
    rows = [(1, 0, "a"), (1, 2, "c"), (1, 1, "b"), (2, 0, "z")]
    df = spark.createDataFrame(rows, "id long, batch_id long, v string").withColumn("run_id", F.lit(0))
    view = {r.id: r.v for r in current_view(df, "id").collect()}
    assert view == {1: "c", 2: "z"}
    replay = df.unionByName(df.where("batch_id = 2"))
    deduped = dedupe_in_batch(replay.withColumn("o", F.lit(1)), "id", "o", ("run_id", "batch_id"))
    assert {r.id: r.v for r in current_view(deduped.drop("o"), "id").collect()} == view


def test_payload_guard(spark):
    df = spark.createDataFrame([("YWJj",), ("!!!",), ("",), (None,)], "p string")
    got = df.select(tx.b64decode_guarded("p").alias("b"), tx.payload_status("p").alias("s")).collect()
    assert (bytes(got[0].b), got[0].s) == (b"abc", "ok")
    assert (got[1].b, got[1].s) == (None, "decode_error")
    assert got[2].s == "empty" and got[3].s == "empty"
    enc = spark.createDataFrame([(b"a" * 100,)], "b binary").select(tx.b64encode("b").alias("e")).first().e
    assert "\r" not in enc and "\n" not in enc


def test_path_algebra(spark):
    df = spark.createDataFrame([("https://m.x.example.net/es/8924.MP4?utm=1",), ("/data/val/horrible/0003.mp4",)],
                               "u string")
    r = df.select(tx.url_host("u").alias("h"), tx.path_segment(tx.url_path("u"), 1).alias("l"),
                  tx.file_stem(tx.path_segment(tx.url_path("u"), -1)).alias("s"),
                  tx.file_ext(tx.url_path("u")).alias("e"), tx.manifest_key(F.lit("horrible"), "u").alias("k")).collect()
    assert (r[0].h, r[0].l, r[0].s, r[0].e) == ("m.x.example.net", "es", "8924", ".mp4")
    assert (r[1].h, r[1].l, r[1].s, r[1].e, r[1].k) == ("", "data", "0003", ".mp4", "horrible_0003")


def test_uniform_sampling_array_form(spark):
    rows = [(i, list(range(n))) for i, (n, *_rest) in enumerate(SAMPLING)]
    df = spark.createDataFrame(rows, "i int, seq array<int>")
    for i, (n, k, bad, kept, pad) in enumerate(SAMPLING):
        ok = (lambda item, pos: F.lit(True)) if bad is None else (lambda item, pos, b=bad: pos != b)
        got = df.where(F.col("i") == i).select(ar.uniform_sample_array("seq", k, ok).alias("s")).first().s
        assert got == kept and k - len(got) == pad


def test_external_model_scoring_matches_mllib(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    from vigil.operators.training import external_scores, linear_predict_fn

    rows = [(i, [float(i % 7), float(i % 3) - 1.0, float((i * 5) % 11) / 10.0], float(i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, x array<double>, label double").withColumn(
        "features", array_to_vector("x"))
    model = LogisticRegression(maxIter=30, family="multinomial").fit(df)
    mllib = {r.id: int(r.prediction) for r in model.transform(df).select("id", "prediction").collect()}
    ext = external_scores(df, "x", linear_predict_fn(model), 3, batch_size=64,
                          class_names=["horrible", "normal", "offensive"], keep=["id"]).collect()
    assert {r.id: r.prediction for r in ext} == mllib
    assert all(abs(sum(r.probability) - 1.0) < 1e-6 for r in ext)
    assert all(r.sensitive == (r.predicted_label != "normal") for r in ext)


def test_encode_with_dimension_and_pooling(spark):
    from vigil.operators.pooling import mean_pool
    from vigil.schemas import label_dimension

    df = spark.createDataFrame([("violent",), ("normal",), ("cat",), (None,)], "label string")
    got = [r.label_idx for r in encode_with_dimension(df, "label", label_dimension(spark)).orderBy("label_idx").collect()]
    assert sorted(got) == [-1, -1, 1, 5]

    vecs = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 4.0]), (1, [5.0, 6.0])], "k int, v array<float>")
    pooled = {r.k: r.mean_vec for r in mean_pool(vecs, ["k"], "v").collect()}
    assert pooled == {0: [2.0, 3.0], 1: [5.0, 6.0]}
    padded = {r.k: r.mean_vec for r in mean_pool(vecs, ["k"], "v", divisor=4).collect()}
    assert padded[0] == [1.0, 1.5]  # two real frames and two zero pads


def test_mean_pool_forms_agree(spark):
    from vigil.operators.pooling import mean_pool, mean_pool_long, mean_pool_vector

    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("label", "embedding")
    a = {r.label: r.mean_vec for r in mean_pool_vector(emb, ["label"], "embedding").collect()}
    b = {r.label: r.mean_vec for r in mean_pool(emb, ["label"], "embedding").collect()}
    c = {(r.label, r.pos): r.mean for r in mean_pool_long(emb, ["label"], "embedding").collect()}
    assert set(a) == set(b)
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-6)
        assert a[k] == pytest.approx([c[(k, i)] for i in range(len(a[k]))], abs=1e-9)


def test_token_places_hash_like_token_bucket(spark):
    from vigil.functions.text import tokens
    from vigil.operators.relational import token_bucket, token_places

    odd = [None, "", " ", "  a  b ", "A É İ ΣΑΣ ς ß x", "\n\t x", "x" * 1000 + " y", "𝔘 😀 a\x00b", "1 2 " * 60]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "id long, text string")
    got = df.select("id", token_places("text", 97).alias("got"), F.transform(tokens("text"), lambda w: token_bucket(w, 97)).alias("want")).collect()
    assert len(got) == len(odd) and all(r.got == r.want for r in got)


def test_first_words_only(spark):
    from vigil.functions.text import word_lengths

    df = spark.createDataFrame([(None,), ("",), ("a",), ("a bb  ccc ",), ("a bb ccc",), (" " * 9,)], "text string")
    assert all(r.whole[:3] == r.first for r in df.select(word_lengths("text").alias("whole"), word_lengths("text", 3).alias("first")).collect())


def test_sampling_makes_the_sequence_once(spark):
    lines = F.split("text", "\n")
    df = spark.createDataFrame([(None,), ("",), ("a\nbb\nccc\n",), ("\n".join(map(str, range(100))),)], "text string")
    got = df.select(ar.uniform_sample_array(lines, 3).alias("got"))
    assert [r.got for r in got.collect()] == [[], [""], ["a", "bb", "ccc"], ["0", "33", "66"]]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
