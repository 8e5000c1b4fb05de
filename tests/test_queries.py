"""Every registered query against its SQL, or for its rows where there is none."""

from __future__ import annotations

import pytest

from prismcube.queries import ORACLES, QUERIES
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(got)
        return
    expected = con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).head(1)
    assert {*entry.oracle_sql()} <= {*entry.queries()}
