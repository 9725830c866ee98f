"""Plan shape checks: pruned scans, pushed filters, no single-partition window over
fact-size input, bounded broadcasts only."""

import __spark_entry__ as se
from conftest import SF001

Q = se.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_prunes_text_column(spark):
    plan = _plan(Q["moderation_report"](spark, SF001))
    scans = [line for line in plan.splitlines() if "documents.parquet" in line]
    assert scans and all("text" not in s.split("ReadSchema:")[1] for s in scans)


def test_flagged_rows_pushes_filter(spark):
    plan = _plan(Q["flagged_rows"](spark, SF001))
    assert "PushedFilters: [IsNotNull(toxic), EqualTo(toxic,1)" in plan.replace(", IsNotNull(doc_id)", "")


def test_split_filter_prunes_partitions(spark):
    plan = _plan(Q["split_filter"](spark, SF001))
    assert "PartitionFilters: [isnotnull(split" in plan and "(split" in plan


def test_sampling_window_is_bounded(spark):
    # the per-sequence window only sees candidates (after the position filter)
    text = Q["uniform_sample_pad"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    window_at = text.find("Window [row_number()")
    assert window_at >= 0 and "Filter" in text[window_at:]


def _unpartitioned_windows(plan: str) -> list[str]:
    """Window operators with an empty partition spec (the whole input in one task)."""
    return [line for line in plan.splitlines() if "Window [" in line and "], [], [" in line]


def test_no_unpartitioned_window_in_fact_queries(spark):
    for name in ("moderation_report", "keyed_upsert", "mean_pool", "split_counts", "modality_join",
                 "confusion_matrix", "eval_cross_entropy", "uniform_sample_pad", "training_set",
                 "malformed_quarantine", "union_batches"):
        assert not _unpartitioned_windows(_plan(Q[name](spark, SF001))), name


def test_two_pass_numbering_at_scale_has_no_unpartitioned_window(spark):
    from vigil.operators.ranking import grouped_row_number

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "source", "lang")
    plan = _plan(grouped_row_number(docs, ["source", "lang"], ["doc_id"]))
    assert not [w for w in _unpartitioned_windows(plan) if "__rk_" not in w]


def test_heavy_scans_are_not_shuffled(spark):
    from vigil.sources.tables import heavy_table

    docs = heavy_table(spark, "/root/testdata/sf0.1", "documents", "doc_id", "text")
    plan = _plan(docs)
    assert "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_size_checks(spark):
    from vigil.operators.joins import provably_at_most

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert provably_at_most(docs.select("lang").distinct(), 10)
    assert not provably_at_most(docs, 10)
    # an estimate over the byte bound decides without running a job
    assert not provably_at_most(docs.select("text"), 10**9, max_bytes=1)


def test_feature_store_scan_prunes_by_split(spark):
    from vigil.plans import QUERIES

    plan = _plan(QUERIES["feature_store_scan"](spark, "/root/testdata/sf0.001"))
    assert "PartitionFilters: [isnotnull(split" in plan


def test_modality_tables_join_without_an_exchange(spark):
    plan = _plan(Q["modality_tables"](spark, SF001))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
