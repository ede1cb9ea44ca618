"""Every registered query against its DuckDB oracle SQL (sf0.001): row
count, column names/types and an order-insensitive value hash."""

import pytest

from tests import oracle_check
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def results(spark):
    from wattlake.plans.registry import QUERIES

    return oracle_check.compare(spark, SF_SMALL, list(QUERIES), verbose=False)


def test_all_queries_match_oracle(results):
    bad = {k: v for k, v in results.items() if v[0] != "ok"}
    assert not bad, bad
    assert len(results) >= 55
