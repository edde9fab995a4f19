"""Every registered query against its SQL check on the smallest tables."""

from __future__ import annotations

import pytest

from workload.check import difference, duck
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with duck(SF_DIR) as opened:
        yield opened


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, connection, name):
    result = QUERIES[name](spark, SF_DIR).toArrow()
    assert difference(result, connection.sql(ORACLES[name]).to_arrow_table()) is None
