"""Physical-plan regressions: the scale properties checked with explain()."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

# model fitting and file-writing queries build their plans through fits/writes
SKIP = ("tune_", "workflow_", "fit_", "stream_", "score_", "best_params", "tvs_ridge", "cv_ridge", "cv_moments", "tvs_moments",
        "logit_odds", "ridge_single", "gbt_stump", "csv_roundtrip", "csv_rescue", "rewrite_band", "window_ordered", "stored_stats", "write_band_tiles", "resample_bucketed", "tvs_auc_choice")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if not n.startswith(SKIP)))
def test_no_cross_joins_or_python_udfs(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert not [k for k in FORBIDDEN if k in p]


def test_flagship_single_scan_single_shuffle(spark):
    p = plan(E.queries()["prepared_split_counts"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1
    assert p.count("Exchange hashpartitioning") == 1
    assert "Join" not in p


def test_label_metrics_single_scan(spark):
    p = plan(E.queries()["label_metrics"](spark, SF_SMALL))
    assert p.count("FileScan parquet") == 1
    assert "Join" not in p


def test_resample_broadcasts_bounded_source(spark):
    p = plan(E.queries()["resample_nearest"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert p.count("FileScan parquet") == 1
