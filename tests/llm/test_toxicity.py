import numpy as np
from pyspark.sql import functions as F

from vigil.llm import toxicity as tx
from vigil.sources.tables import table

SF01 = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    model = tx.train_on(docs, labels)
    held = labels.where(~tx.may_learn()).select("doc_id", "toxic")
    rows = tx.score(docs, model).join(held, F.col("id") == F.col("doc_id")).select("score", "toxic").toPandas()
    said, true = rows.score >= 0.3, rows.toxic == 1
    assert len(rows) > 500 and (said & true).sum() / true.sum() > 0.8 and (said & ~true).sum() / (~true).sum() < 0.02


def test_only_learnable_rows_are_learnt_from(spark):
    docs = spark.createDataFrame([(i, "bad words here" if i % 2 else "good words there") for i in range(400)], "doc_id long, text string")
    right = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    spoiled = right.withColumn("toxic", F.when(tx.may_learn(), F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert np.allclose(tx.train_on(docs, right).weights, tx.train_on(docs, spoiled).weights)


def test_presence_matches_brute_force():
    texts = ["Hello  hello", "", "a", "é日本🙂x" * 3, "b" * 50]
    of, place = tx._presence([tx._prepared(t.encode()) for t in texts])
    for n, t in enumerate(texts):
        one, p = tx._presence([tx._prepared(t.encode())])
        assert sorted(place[of == n].tolist()) == sorted(p.tolist())
    grams = {s[i:i + n] for s in [" hello hello "] for n in tx.SIZES for i in range(len(s) - n + 1)}
    assert abs((of == 0).sum() - len(grams)) <= 1  # hashing may join a few


def test_edge_rows(spark):
    rows = [(1, None, 1), (2, "", 0), (3, "very bad " * 3000, 1), (4, "nice", 0), (None, "bad", 1), (5, "bad", None), (4, "nice", 0)]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t, _ in rows], "doc_id long, text string, label string, score double")
    labels = spark.createDataFrame([(i, n) for i, _, n in rows], "doc_id long, toxic int")
    model = tx.train_on(docs, labels)
    got = tx.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = tx.train_on(docs, labels.limit(0))
    assert {r.score for r in tx.score(docs, none).collect()} == {0.0}
    one_class = tx.train_on(docs, labels.where("toxic = 1"))
    assert all(r.score in (0.0, 1.0) for r in tx.score(docs, one_class).collect())
    assert tx.score(docs.limit(0), model).count() == 0
    kept = tx.keep_below(docs, none, 0.3)
    assert kept.columns == docs.columns and kept.count() == len(rows)
