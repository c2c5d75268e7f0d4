"""Every registered query equals its SQL counterpart.

The smallest tables hold no well-covered feature row, so whatever needs training
rows runs on larger ones.
"""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, oracle_connection
from checks.table_queries import TREES
from tickflow.operators.modelling import TreeSpec

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
NEEDS_ROWS = {
    "feature_importance",
    "gbt_scores",
    "har_eval",
    "har_predictions",
    "metric_names",
    "model_eval",
    "persistence_eval",
    "promotion",
    "run_record",
}


@pytest.fixture(scope="module")
def oracles():
    return {path: oracle_connection(path) for path in (SMALL, LARGER)}


def test_contract():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 80


def test_registered_models_fit_all_trees():
    assert TREES == TreeSpec()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, oracles, name):
    path = LARGER if name in NEEDS_ROWS else SMALL
    df = entry.queries()[name](spark, path)
    verdict, _ = compare(df, oracles[path], entry.oracle_sql().get(name))
    assert verdict.startswith("ok"), verdict
