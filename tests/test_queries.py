import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from seriesloom.registry.base import ORACLES, QUERIES

# Minutes of fitting each; their parts are tested on small frames. Run with SERIESLOOM_HEAVY=1.
HEAVY = {
    "forecast_boosted", "boosting_history", "forecast_with_scores", "forecast_with_cluster_score", "score_by_cluster",
    "score_by_similarity", "word_vectors",
}
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    assert entry.entry(spark).count() == 25


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    same, message = compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER)
    assert same, message


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, con, name):
    if name in HEAVY and not os.environ.get("SERIESLOOM_HEAVY"):
        pytest.skip("heavy")
    same, message = compare(spark, con, name, QUERIES[name], None, FOLDER)
    assert same, message
