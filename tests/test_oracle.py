"""Every registered query against its DuckDB oracle (sf0.001); queries without an
oracle must at least run and return rows."""

import pytest

import __spark_entry__ as se
from vigil import plans
from vigil.config import TrainConfig
from vigil.operators.split import hash_split
from conftest import SF0001
from oracle_compare import compare, duck

QUERIES = dict(plans.QUERIES)  # those of vigil.llm have tests of their own
ORACLES = dict(plans.ORACLES)
ML = {"train_early_stop", "model_selection", "batch_score", "stream_score", "external_score", "model_evaluation"}


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_ops_and_most_have_oracles():
    from vigil.plans.catalog import OPS

    assert set(OPS) == set(QUERIES)
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= len(QUERIES) - 8


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF0001).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert compare(got, want) == "OK"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - ML))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF0001).count() > 0


def test_training_and_scoring(spark):
    hist = QUERIES["train_early_stop"](spark, SF0001).collect()
    # the loop ends by patience, not by its bound on rounds
    assert len(hist) < TrainConfig().max_rounds and not any(r.improved for r in hist[-TrainConfig().patience:])
    scored = QUERIES["batch_score"](spark, SF0001)
    n_docs = spark.read.parquet(f"{SF0001}/documents.parquet").count()
    rows = scored.collect()
    assert len(rows) == n_docs
    assert all(r.predicted_label in ("normal", "offensive") for r in rows)
    assert all(r.sensitive == (r.predicted_label == "offensive") for r in rows)
    labels = spark.read.parquet(f"{SF0001}/labels.parquet").select("doc_id").distinct()
    n_test = hash_split(labels, "doc_id").where("split = 'test'").count()
    assert sum(r.n_actual for r in QUERIES["model_evaluation"](spark, SF0001).collect()) == n_test > 0
    sel = QUERIES["model_selection"](spark, SF0001).collect()
    assert sum(r.selected for r in sel) == 1 and {r.model for r in sel} == {"fusion", "tiny", "simple"}
    streamed = QUERIES["stream_score"](spark, SF0001).collect()
    assert sorted(r.doc_id for r in streamed) == sorted(r.doc_id for r in rows)
    external = QUERIES["external_score"](spark, SF0001).collect()
    assert sorted(r.doc_id for r in external) == sorted(r.doc_id for r in rows)
    assert all(r.predicted_label in ("normal", "offensive") for r in external)


def test_saved_model_restores(spark):
    from vigil.plans import models

    found = models.train_models(spark, SF0001)
    again = models.trained(spark, SF0001)
    assert again.path == found.path and again.model == found.model and len(found.model.history) > 4


def test_entry(spark):
    df = se.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"lang", "n_items", "n_sensitive", "n_low_quality",
                                                  "sensitive_share"}


@pytest.mark.parametrize("name", ["rename_plan", "split_exact", "split_hash", "batch_order", "class_index_sorted"])
def test_numbering_and_splits_match_oracle_on_more_rows(spark, name):
    from oracle_compare import duck as duck_at

    sf = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, sf).toPandas()
    want = duck_at(sf).execute(ORACLES[name]).df()
    assert compare(got, want) == "OK"
