"""Plan checks: no conditioned nested-loop join and no unbounded single-task window."""

import re

import pytest

from pitlane.plans.registry import all_queries
from conftest import SF_SMALL

# queries that write or fit while they are built: their plans are of what they wrote
SKIP = {"fit_win", "fit_ridge", "fit_gbt", "fit_lasso_enet", "fit_logit_inference", "fit_random_forest", "fit_random_forest_plain", "fit_random_forest_price",
        "oof_predict", "stack_ridge", "tune", "score_batch", "player_projection", "backtest", "src_csv", "sink_csv",
        "sink_day_document", "sink_payload_append", "refresh_snapshot", "stream_delta_load"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries()) - SKIP))
def test_no_nested_loop_join_with_condition(spark, name):
    plan = _plan(all_queries()[name](spark, SF_SMALL))
    for line in plan.splitlines():
        if "BroadcastNestedLoopJoin" in line or "CartesianProduct" in line:
            # only one-row crosses (scalar aggregates) are allowed: no join condition
            assert re.search(r"(Cross|Inner)\s*$", line.strip()), line


def test_or_join_is_an_equi_join(spark):
    plan = _plan(all_queries()["or_key_join"](spark, SF_SMALL))
    assert "NestedLoop" not in plan


def test_last_n_form_prelimits_before_shuffle(spark):
    plan = _plan(all_queries()["last_n_form"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan


def test_rolling_frames_move_full_rows_once(spark):
    """Behind the join with the bucket counts there is one exchange of rows, by (entity, chunk)."""
    from pyspark.sql import functions as F

    from pitlane.operators.pit import rolling_rows
    df = spark.range(10_000).select((F.col("id") % 7).alias("e"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("d"), F.col("id"), F.rand(1).alias("x"))
    df.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/rolling-plan")
    out = rolling_rows(spark.read.parquet(path), "e", ["d", "id"], {"m": "x"}, 10)
    out.write.format("noop").mode("overwrite").save()
    plan = _plan(out)
    assert sum("_chunk" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line) == 1
    assert "Window [" in plan and "windowspecdefinition(e" in plan


def _windows(plan):
    """(partition columns, text) of the Window operators of a plan."""
    return [(m.group(1), line) for line in plan.splitlines() if (m := re.search(r"windowspecdefinition\(([^()]*)", line))]


@pytest.mark.parametrize("name", ["rank_in_group", "stratified_split", "rolling_avg_incl", "volatility", "target_encode_oof", "describe", "robust_scale"])
def test_no_window_gathers_rows_in_one_task(spark, name):
    """Windows over rows are cut by a bucket or chunk; those over whole groups run over bucket counts only."""
    plan = all_queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    for _, line in _windows(plan):
        assert re.search(r"_k#|_b#|_chunk#|_kn#|_kb#|_n\d*#|_m2?#", line), line
