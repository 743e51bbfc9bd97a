"""Every query of the engine against its SQL, over the smallest tables."""

from __future__ import annotations

import pytest

from tests.oracle import assert_same, connect
from tidewater import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    sql = catalog.oracle_sql().get(name)
    if sql:
        assert_same(df, con, sql)
    else:
        assert df.count() >= 0


def test_every_query_names_what_it_covers():
    from tidewater.plans.registry import ALL

    assert all(q.covers for q in ALL.values())
