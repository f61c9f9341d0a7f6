"""Bronze to Silver (C1-C4, E16). Every job ends in the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.contract import Contract
from larder.operators.dedupe import first_pair_per_key, first_per_key


def clean_orders(bronze: DataFrame) -> DataFrame:
    """Typed orders, first-order gap filled, bucket, one row per order id; columns and rules are the contract's."""
    contract = Contract.named("silver/orders")
    return contract.with_added(first_per_key(contract.typed(bronze), ["order_id"]))


def clean_order_products(bronze: DataFrame) -> DataFrame:
    """Typed lines, bucket, one row per order and product; columns and rules are the contract's."""
    contract = Contract.named("silver/order_products")
    unique = first_pair_per_key(
        contract.typed(bronze), ["order_id", "product_id"], "add_to_cart_order", "reordered"
    )
    return contract.with_added(unique)


def lookup(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Left join of a table that has one row per integer ``key``.

    No broadcast is forced: Spark broadcasts ``names`` when its size, known from
    the files or measured at run time, is below the session's threshold, and
    shuffles otherwise. Joining on a wider type than ``names`` was made unique
    by gives both sides a shuffle of their own, which lets adaptive execution
    split a key that holds a large part of ``rows``.
    """
    wide = names.withColumnRenamed(key, "_key")
    matches = F.col(key).cast("long") == F.col("_key").cast("long")
    return rows.join(wide, matches, "left").drop("_key")


def build_products(
    products: DataFrame, aisles: DataFrame, departments: DataFrame
) -> DataFrame:
    """One row per product with aisle and department names.

    A product whose aisle or department never arrived keeps a NULL name.
    """
    contract = Contract.named("silver/products")
    unique = first_per_key(contract.typed(products), ["product_id"])

    def names(rows: DataFrame, kind: str) -> DataFrame:
        named = rows.select(f"{kind}_id", F.col(kind).alias(f"{kind}_name"))
        return first_per_key(contract.typed(named), [f"{kind}_id"])

    named = lookup(lookup(unique, names(aisles, "aisle"), "aisle_id"), names(departments, "department"), "department_id")
    return contract.with_added(named)
