"""Plan checks over the registered catalogue."""

import re

import pytest

from vela.plans import catalog

ROWS_ONLY_HEAVY = {"train_rf", "train_gbt", "train_lr", "train_mlp", "tune_lr", "score_two_versions",
                   "model_roundtrip", "stream_score", "stream_linear_scores", "stream_scoring_metrics", "stream_event_counters", "lineage_stream", "lineage_stream_late"}
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - ROWS_ONLY_HEAVY))
def test_query_plan_is_jvm_side_and_join_safe(spark, sf, name):
    plan = _plan(catalog.queries()[name](spark, sf))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_single_partition_windows_only_on_bounded_tables(spark, sf):
    # roc_auc's only un-partitioned window runs over the per-bucket totals (one row per bucket)
    plan = _plan(catalog.queries()["roc_auc"](spark, sf))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)
    assert sum(1 for w in windows if w.strip() == "") <= 1


def test_top_n_per_group_is_limited_before_the_shuffle(spark, sf):
    plan = _plan(catalog.queries()["snapshot_sample"](spark, sf))
    assert "WindowGroupLimit" in plan and "Partial" in plan
