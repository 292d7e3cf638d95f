"""The corpus queries that SQL can express, against it."""

import os

import pytest

from sparkloom.llm import oracles, queries

from ..oracle import SF, compare, database

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query(spark, name):
    compare(queries.QUERIES[name](spark, SF), database().execute(oracles.ORACLES[name]))
