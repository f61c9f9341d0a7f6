"""Silver to Gold: user and product features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import bucket_of
from larder.operators.running import running_totals
from larder.sources.storage import Scratch

FEATURE_COLUMNS = (
    "user_id",
    "product_id",
    "order_count",
    "reorder_rate",
    "avg_cart_position",
    "days_since_last_order",
    "user_total_orders",
    "product_popularity",
    "aisle_name",
    "department_name",
    "user_id_bucket",
)


def of_set(orders: DataFrame, eval_set: str) -> DataFrame:
    """P5: orders of one evaluation set."""
    return orders.filter(F.col("eval_set") == eval_set)


def user_timeline(orders: DataFrame) -> DataFrame:
    """Days since a user's first order, one row per user and order number.

    Also the user's last day over all orders, and their number of prior orders.
    """
    points = running_totals(
        orders,
        ["user_id"],
        "order_number",
        {
            "days": F.col("days_since_prior_order"),
            "prior": (F.col("eval_set") == "prior").cast("int"),
        },
    )
    return points.select(
        "user_id",
        "order_number",
        F.col("days_running").alias("cum_days"),
        F.col("days_total").alias("last_day"),
        F.col("prior_total").alias("user_total_orders"),
    )


def orders_on_timeline(orders: DataFrame) -> DataFrame:
    """Prior orders with the day they were placed and their user's totals.

    User totals are joined here, to orders, and carried along by the pair
    aggregate, so the much larger pairs never need a join on the user.
    """
    prior = of_set(orders, "prior").select("order_id", "user_id", "order_number")
    return prior.join(user_timeline(orders), ["user_id", "order_number"])


def prior_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of prior orders with their user and timeline."""
    bought = lines.select("order_id", "product_id", "add_to_cart_order", "reordered")
    return bought.join(orders_on_timeline(orders), "order_id")


def user_product_stats(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per user and product bought in a prior order."""
    return (
        prior_lines(orders, lines)
        .groupBy("user_id", "product_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.round(F.avg(F.col("reordered").cast("int")), 6).alias("reorder_rate"),
            F.round(F.avg("add_to_cart_order"), 6).alias("avg_cart_position"),
            (F.max("last_day") - F.max("cum_days")).alias("days_since_last_order"),
            F.max("user_total_orders").alias("user_total_orders"),
        )
    )


def user_totals(orders: DataFrame) -> DataFrame:
    """Number of prior orders per user."""
    prior = of_set(orders, "prior")
    return prior.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_total_orders"))


def product_popularity(pairs: DataFrame) -> DataFrame:
    """Lines of prior orders per product, from the pair counts."""
    return pairs.groupBy("product_id").agg(F.sum("order_count").alias("product_popularity"))


def user_product_features(
    orders: DataFrame, lines: DataFrame, products: DataFrame, scratch: Scratch
) -> DataFrame:
    """The Gold feature table.

    Pairs feed both the popularity and the result, so they are written once.
    Popularity and names are brought together per product first, and written as
    well: the last join then reads two stored tables. Spark broadcasts the
    product table if its files are small, and otherwise shuffles both sides and
    splits products that hold a large part of all pairs.
    """
    pairs = scratch.stage(user_product_stats(orders, lines), "pairs")
    names = products.select("product_id", "aisle_name", "department_name")
    per_product = scratch.stage(
        product_popularity(pairs).join(names, "product_id", "left"), "per_product"
    )
    return (
        pairs.join(per_product, "product_id")
        .withColumn("user_id_bucket", bucket_of(F.col("user_id")))
        .select(*FEATURE_COLUMNS)
    )


def department_reorder_rate(
    orders: DataFrame, lines: DataFrame, products: DataFrame
) -> DataFrame:
    """Lines and reorder rate of prior orders per department.

    Lines are summed per product before the names are joined, so the join and
    the last aggregate handle one row per product.
    """
    prior = of_set(orders, "prior").select("order_id")
    bought = lines.select("order_id", "product_id", "reordered").join(
        prior, "order_id", "left_semi"
    )
    again = F.col("reordered").cast("long")
    per_product = bought.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(again).alias("reordered_lines")
    )
    names = products.select("product_id", "department_name")
    return (
        per_product.join(names, "product_id", "left")
        .groupBy("department_name")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("reordered_lines").alias("reordered_lines"),
            F.round(F.sum("reordered_lines") / F.sum("lines"), 6).alias("reorder_rate"),
        )
    )
