"""Every registered query against its SQL, on tables with hot keys.

The tables are the smallest given ones with a third of all orders moved to one
user, a third of all lines to one order and to one product, and a third of the
parts to one brand.
"""

from pathlib import Path

import pytest

import __spark_entry__ as registered
from checks.compare import difference, oracle_connection
from checks.oracle import ORACLE_SQL

GIVEN = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not GIVEN.exists(), reason="given tables not here")

HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_linenumber % 3 = 0 THEN 12 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_suppkey % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey)""",
    "part": "SELECT * REPLACE (CASE WHEN p_size % 3 = 0 THEN 'Brand#4' ELSE p_brand END AS p_brand)",
    "events": "SELECT *",
}


@pytest.fixture(scope="module")
def hot_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    given = oracle_connection(str(GIVEN))
    for table, select in HOT.items():
        given.execute(f"COPY ({select} FROM {table}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def oracle(hot_folder):
    return oracle_connection(hot_folder)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_sql(spark, hot_folder, oracle, name):
    result = registered.queries()[name](spark, hot_folder)
    assert difference(result, oracle, registered.oracle_sql()[name]) is None


def test_every_sql_has_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns == ["department_name", "lines", "reordered_lines", "reorder_rate"]
    assert result.count() > 0
