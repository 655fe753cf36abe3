"""Every registered query gives the rows of its SQL."""

import pytest

from checks import ORACLES, QUERIES
from checks.compare import connect, differences


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, duck, name):
    assert differences(QUERIES[name](spark, folder), duck, ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    import __spark_entry__
    assert __spark_entry__.entry(spark).count() == 10
