"""Every registered query of the text operators that has SQL, against it."""

from __future__ import annotations

import pytest
from compare import difference, duck

from replenish.llm.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(DATA)


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_statement(spark, connection, name):
    assert difference(spark, connection, QUERIES[name], SQL[name], DATA) is None
