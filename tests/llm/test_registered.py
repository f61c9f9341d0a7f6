"""Registered queries against their SQL, on the smallest given tables."""

from pathlib import Path

import pytest

from checks.compare import difference, oracle_connection
from larder.llm.queries import ORACLE_SQL, QUERIES

GIVEN = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not GIVEN.exists(), reason="given tables not here")
@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_sql(spark, name):
    result = QUERIES[name](spark, str(GIVEN))
    assert difference(result, oracle_connection(str(GIVEN)), ORACLE_SQL[name]) is None
