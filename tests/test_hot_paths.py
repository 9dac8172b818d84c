"""The position plans at their smallest parts: one value bucket for floats, two
integers in a bucket, chunks of a few rows.  Results must still equal the
DuckDB oracles."""

import pytest

from pitlane.plans.registry import all_oracles, all_queries
from conftest import SF_SMALL
from oracle_compare import duck, run_pair
from pitlane.operators import pit, positions

HOT = ["rolling_avg_incl", "rolling_avg_excl", "rolling_avg_full", "team_features_with_rest", "strength_of_schedule",
       "player_rolling", "blended_form", "match_matrix", "group_median_mode", "describe", "fill_group_median",
       "target_encode_oof", "robust_scale", "interval_empirical", "miss_analysis", "rank_in_group", "volatility",
       "composite_sigma",
       "composite_rank_score", "top1_per_group", "group_report", "value_counts"]


@pytest.fixture(scope="module")
def forced():
    with pytest.MonkeyPatch.context() as m:
        m.setattr(pit, "CHUNK_ROWS", 7)
        m.setattr(positions, "FLOAT_BUCKETS", 1)
        m.setattr(positions, "INT_BITS", 1)
        m.setattr(positions, "STRING_CHARS", 1)
        yield


@pytest.mark.parametrize("name", HOT)
def test_hot_plan_matches_oracle(spark, forced, name):
    problems, _ = run_pair(spark, duck(SF_SMALL), name, all_queries()[name], all_oracles()[name], SF_SMALL)
    assert not problems, "\n".join(problems)
