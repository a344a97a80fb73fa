"""Every query against its DuckDB statement, on the smallest tables."""

from __future__ import annotations

import pytest

from checks.compare import differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SLOW = {"rf_baseline_vs_fair", "rf_feature_importance", "rf_simple_model", "model_roundtrip"}  # see test_models


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, sf, oracle, name):
    count, problem = differences(spark, oracle, name, sf)
    assert problem == ""
    assert count > 0
