"""Every registered query equals its oracle on the smallest data set."""

import pytest

from strandmart.checks import ORACLES, QUERIES
from tests.compare import compare, database
from tests.conftest import DATA


@pytest.fixture(scope="module")
def con():
    return database(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    rows, problem = compare(spark, con, DATA, name, QUERIES[name], ORACLES.get(name))
    assert not problem, problem
    assert rows > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
