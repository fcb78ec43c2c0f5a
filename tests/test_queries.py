"""Every query with an SQL twin gives the same rows; the others run and keep their promises."""

import pytest
from compare import compare, connect

from scorelake.plans import catalog

ORACLES = catalog.oracles()
HEAVY = {"rfecv", "predictive_power", "compare_models", "cross_validate_balanced", "rfe", "batch_score", "train_gbt"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf, con, name):
    assert compare(catalog.queries()[name](spark, sf), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(ORACLES) - HEAVY))
def test_runs(spark, sf, name):
    rows = catalog.queries()[name](spark, sf).collect()
    assert rows
    for row in rows:
        values = row.asDict()
        for field in ("prediction_probability", "mean_auc", "u"):
            if values.get(field) is not None:
                assert 0 <= values[field] <= 1
