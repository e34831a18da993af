"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference, duck

from replenish.fixtures import oracle
from replenish.fixtures.queries import QUERIES

DATA = "/root/testdata/sf0.001"
STATEMENTS = oracle.statements()


@pytest.fixture(scope="module")
def connection():
    return duck(DATA)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query_equals_statement(spark, connection, name):
    assert difference(spark, connection, QUERIES[name], STATEMENTS[name], DATA) is None
