import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline as cp
from test_decontaminate import brute as leaks_of
from test_minhash import brute as groups_of
from vigil.llm import pii
from vigil.llm import toxicity as tx
from vigil.sources.tables import table

SF0001 = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and what it returned."""
    from vigil.session import materialize

    out, docs = {}, table(spark, SF0001, "documents")
    for name, stage in cp.STAGES:
        given, docs = docs, materialize(stage(spark, docs, SF0001), f"test-{name}")
        out[name] = (given, docs)
    return out


def test_the_stages_and_their_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "sentencepiece"]
    assert all(out.columns == COLUMNS for n, (_, out) in stages.items() if n != "sentencepiece")


def test_toxic_documents_go(spark, stages):
    given, out = stages["toxicity"]
    scores = tx.score(given, tx.train_on(given, table(spark, SF0001, "labels")))
    assert rows_of(out) == rows_of(given.join(scores.where(F.col("score") < 0.3).withColumnRenamed("id", "doc_id").select("doc_id"), "doc_id").select(COLUMNS))


def test_one_of_each_group_stays(stages):
    given, out = stages["near_duplicates"]
    kept = {i for i, (_, _, k) in groups_of([(r.doc_id, r.text) for r in given.collect()], 5).items() if k}
    assert rows_of(out) == [r for r in rows_of(given) if r[0] in kept] and out.count() < given.count()


def test_leaks_go(spark, stages):
    given, out = stages["decontamination"]
    found = leaks_of([(r.doc_id, r.text) for r in given.collect()], [(r.item_id, r.text) for r in table(spark, SF0001, "benchmark").collect()])
    bad = {d for d, _ in found}
    assert rows_of(out) == [r for r in rows_of(given) if r[0] not in bad] and bad


def test_personal_data_is_replaced(stages):
    given, out = stages["personal_data"]
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (given, out))
    assert before.keys() == after.keys()
    assert any(pii.base_spans(t) for t in before.values())
    for i, t in before.items():
        assert pii.base_spans(after[i]) == []
        if not pii.base_spans(t) and not pii.loose_spans(t):
            assert after[i] == t


def test_ids_are_the_library_s(stages):
    given, out = stages["sentencepiece"]
    lib = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: list(r.ids) for r in out.collect()} == {r.doc_id: lib.encode(r.text) for r in given.collect()}


def test_run_chains_the_stages(spark, stages):
    assert rows_of(cp.run(spark, SF0001).drop("ids")) == rows_of(stages["sentencepiece"][1].drop("ids"))


def test_empty_and_null_documents(spark, tmp_path):
    for t in ("labels", "benchmark"):
        table(spark, SF0001, t).write.parquet(f"{tmp_path}/{t}.parquet")
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "word " * 20000, None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 5 and np.isclose(docs.agg(F.max("n_tokens")).first()[0], len(SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")).encode("word " * 20000)))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0


def test_extra_columns_with_clashing_names(spark, tmp_path):
    for t in ("labels", "benchmark"):
        table(spark, SF0001, t).write.parquet(f"{tmp_path}/{t}.parquet")
    names = ["id", "copy", "copy_", "kept", "component_id", "toxic", "score", "found", "word", "label", "n_tokens_given"]
    docs = table(spark, SF0001, "documents").where("doc_id < 60")
    plain = docs
    wide = docs.select("*", *[F.lit(f"x{i}").alias(n) for i, n in enumerate(names)])
    for name, stage in cp.STAGES:
        wide, plain = stage(spark, wide, str(tmp_path)), stage(spark, plain, str(tmp_path))
        if name != "sentencepiece":
            assert wide.columns == COLUMNS + names
            assert rows_of(wide.select(COLUMNS)) == rows_of(plain)
            assert wide.where("copy is distinct from 'x1' or label is distinct from 'x9'").count() == 0
    assert rows_of(wide.drop("ids")) == rows_of(plain.drop("ids"))
