"""Each query against its SQL, over the smallest tables."""

import os

import pytest

from sparkloom.plans import oracles, queries

from .oracle import SF, compare, database

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(queries.Q))
def test_query(spark, name):
    df = queries.Q[name](spark, SF)
    if name in oracles.ORACLES:
        compare(df, database().execute(oracles.ORACLES[name]))
    else:
        assert df.count() > 0
