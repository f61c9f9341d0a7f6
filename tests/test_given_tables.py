"""The tables that the queries derive from the given ones."""

from datetime import datetime, timedelta

import pytest

from checks import driver_tables
from checks.driver_tables import DriverTables
from larder.operators import running
from larder.sources.storage import Scratch
from tests.conftest import plan_of, rows


@pytest.mark.parametrize("bits", [16, 1])
def test_lines_know_earlier_orders_of_their_pair(spark, tmp_path, monkeypatch, bits):
    """One shuffle of the lines where all order numbers are in one block; the same rows where they are not."""
    monkeypatch.setattr(driver_tables, "block_of", lambda c, b=bits: running.block_of(c, b))
    orders = [(n, n % 3 or None, datetime(2024, 1, 1) + timedelta(days=n // 2)) for n in range(1, 40)]
    lines = [(n, 20 * (n % 5) + k if n % 7 else None, k) for n in range(1, 45) for k in (1, 2, 30)] * 2
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_linenumber int"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    given = DriverTables(spark, str(tmp_path), Scratch(spark))
    found = given._lines()
    user = {n: u for n, u, _ in orders if u}
    at = {}
    for n, u, day in sorted(orders, key=lambda o: (o[2], o[0])):
        at[n] = sum(1 for x in at if user.get(x) == u)
    first = {}
    for n, part, _ in lines:
        if n in user and part is not None:
            pair = user[n], part // 20
            first[pair] = min(first.get(pair, 99), at[n])
    plain = [
        (n, part // 20, k, at[n] > first[user[n], part // 20]) for n, part, k in lines if n in user and part is not None
    ]
    assert rows(found, "order_id", "product_id", "add_to_cart_order", "again") == sorted(plain, key=repr)
    if bits == 16:
        assert plan_of(found).count("hashpartitioning") == 1 and "SortMergeJoin" not in plan_of(found)


def test_orders_are_numbered_alike_by_user_and_by_blocks(spark, tmp_path, monkeypatch):
    """Also with missing users, days and ids, and rows that come twice; by user, orders are shuffled once."""
    days = [datetime(2024, 1, 1) + timedelta(days=n) for n in range(6)]
    orders = [
        (None if n % 11 == 3 else n << 18, None if n % 7 == 5 else n % 4, None if n % 9 == 4 else days[n * 5 % 6])
        for n in range(90)
    ] + [(9 << 18, 1, days[5])] * 2
    data = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp")
    data.write.parquet(str(tmp_path / "orders.parquet"))
    given = DriverTables(spark, str(tmp_path), Scratch(spark))
    by_user = given.true_orders()
    assert "Join" not in plan_of(by_user) and plan_of(by_user).count("Exchange") == 1
    monkeypatch.setattr(driver_tables, "USER_ORDERS", 5)
    by_blocks = given.true_orders()
    assert "Join" in plan_of(by_blocks)
    assert by_user.schema == by_blocks.schema and rows(by_user) == rows(by_blocks) != []
