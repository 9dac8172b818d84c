"""Every registered query against its DuckDB oracle (or rows-only) at sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import duck, run_pair

from pitlane.plans.registry import all_oracles, all_queries

QUERIES = all_queries()  # without those of the optional subpackage, which has its own tests
ORACLES = all_oracles()
ML = {"fit_gbt", "fit_random_forest", "fit_random_forest_plain", "fit_random_forest_price",
      "player_projection"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_registry_shape():
    assert len(QUERIES) >= 130
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == ML


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["game_id", "team_id", "scheduled_date_et", "is_home"] or "game_id" in df.columns
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    problems, n = run_pair(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert not problems, "\n".join(problems)


@pytest.mark.parametrize("name", sorted(ML))
def test_model_jobs_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0
