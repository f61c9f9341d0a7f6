"""Grocery Bronze tables derived from the given star-schema and event tables.

FIXTURES.md, section 3, states every derivation as SQL. All rows of the source
tables are used. Dirt is part of the derivation: repeated orders, repeated
lines, catalog records sent many times with other contents, malformed events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.operators.running import block_of, block_offsets
from larder.sources.storage import Scratch

# Ids per block when orders of one user and day are numbered.
ID_BLOCK_BITS = 20
# Most orders of a user that are numbered in one task.
USER_ORDERS = 1 << 16
# Neighbouring parts form one grocery product, so that users buy products again.
PARTS_PER_PRODUCT = 20


class DriverTables:
    """Orders and lines that several tables derive from are written to ``scratch`` once."""

    def __init__(self, spark: SparkSession, folder: str, scratch: Scratch):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.scratch = scratch
        self.written: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.written:
            self.written[name] = self.scratch.stage(build(), f"given/{name}")
        return self.written[name]

    # ---- orders -------------------------------------------------------------

    def true_orders(self) -> DataFrame:
        """One clean row per order, numbered within its user by date and id.

        Where no user has more than ``USER_ORDERS``, a window over the user numbers
        them. Otherwise a user's orders are numbered in blocks of one day and a range
        of ids, so that a user with very many orders is spread over tasks: inside a
        block by a window over the block, between blocks by a window over block counts.
        """
        block = ["user_id", "day", "_block"]
        source = (
            self.table("orders")
            .select(
                F.col("o_orderkey").cast("int").alias("order_id"),
                F.col("o_custkey").cast("int").alias("user_id"),
                F.to_date("o_orderdate").alias("day"),
            )
            .withColumn("_block", block_of("order_id", ID_BLOCK_BITS))
        )
        per_user = source.filter("user_id IS NOT NULL").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        if (per_user.agg(F.max("n")).first()[0] or 0) <= USER_ORDERS:
            return self._with_numbers(_numbered_by_user(source).dropna(subset=block))
        counts = source.groupBy(*block).agg(F.count(F.lit(1)).alias("n"))
        by_day = Window.partitionBy("user_id").orderBy("day", "_block")
        offsets = block_offsets(
            counts.withColumn("prior_day", F.lag("day").over(by_day)),
            ["user_id"],
            ["day", "_block"],
            ["n"],
        )
        nth = F.row_number().over(Window.partitionBy(*block).orderBy("order_id"))
        numbered = source.withColumn("nth", nth).join(offsets, block)
        gap = F.when(F.col("nth") > 1, F.lit(0)).otherwise(F.datediff("day", "prior_day"))
        return self._with_numbers(numbered.withColumn("number", F.col("n_before") + F.col("nth")).withColumn("gap", gap))

    def _with_numbers(self, numbered: DataFrame) -> DataFrame:
        """The columns of true orders, from ``number``, ``n_total`` and ``gap``."""
        number = F.col("number").cast("int")
        eval_set = (
            F.when(number < F.col("n_total"), "prior")
            .when(F.col("user_id") % 3 == 0, "test")
            .otherwise("train")
        )
        return numbered.select(
            "order_id",
            "user_id",
            eval_set.alias("eval_set"),
            number.alias("order_number"),
            (F.dayofweek("day") - 1).alias("order_dow"),
            (F.col("order_id") % 24).alias("order_hour_of_day"),
            F.col("gap").cast("double").alias("days_since_prior_order"),
        )

    def bronze_orders(self) -> DataFrame:
        """Every tenth order arrives twice."""
        orders = self.written["orders"] if "orders" in self.written else self.true_orders()
        return _sent_twice(orders, F.col("order_id") % 10 == 0)

    # ---- order lines --------------------------------------------------------

    def _placed(self) -> DataFrame:
        """Lines with their order's user, set and number."""
        lines = self.table("lineitem").select(
            F.col("l_orderkey").cast("int").alias("order_id"),
            product_of("l_partkey").alias("product_id"),
            F.col("l_linenumber").cast("int").alias("add_to_cart_order"),
        )
        orders = self.once("orders", self.true_orders)
        placed = lines.join(
            orders.select("order_id", "user_id", "eval_set", "order_number"), "order_id"
        )
        return placed.withColumn("_block", block_of("order_number"))

    def _lines(self) -> DataFrame:
        """Lines with whether the user had the product in an earlier order.

        Where all order numbers lie in one block, a pair has few lines, and one shuffle
        of the lines brings them together. Otherwise a pair's first order is taken per
        block of order numbers, then over the blocks, and meets the lines on pair and
        block, not on the pair alone.
        """
        pair = ["user_id", "product_id", "_block"]
        orders = self.once("orders", self.true_orders)
        blocks = orders.agg(F.min(block_of("order_number")), F.max(block_of("order_number"))).first()
        if blocks[0] == blocks[1]:
            first = F.min("order_number").over(Window.partitionBy(*pair))
            found = self._placed().dropna(subset=pair).withColumn("first_order", first)
        else:
            placed = self.once("placed", self._placed)
            first_in_block = placed.groupBy(*pair).agg(F.min("order_number").alias("n"))
            of_pair = Window.partitionBy("user_id", "product_id")
            first = first_in_block.select(*pair, F.min("n").over(of_pair).alias("first_order"))
            found = placed.join(first, pair)
        again = F.col("order_number") > F.col("first_order")
        return found.select("order_id", "product_id", "add_to_cart_order", "eval_set", again.alias("again"))

    def bronze_order_products(self, eval_set: str = "prior") -> DataFrame:
        """Lines of one set; ``reordered`` is text in two spellings."""
        word = F.when(F.col("again"), "true").otherwise("false")
        digit = F.when(F.col("again"), "1").otherwise("0")
        return (
            self.once("lines", self._lines)
            .filter(F.col("eval_set") == eval_set)
            .select(
                "order_id",
                "product_id",
                "add_to_cart_order",
                F.when(F.col("order_id") % 7 == 0, word).otherwise(digit).alias("reordered"),
            )
        )

    # ---- catalog ------------------------------------------------------------

    def bronze_products(self) -> DataFrame:
        """One record per part: many differing records per product, ids as text."""
        return self.table("part").select(
            product_of("p_partkey").cast("string").alias("product_id"),
            F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("product_name"),
            aisle_of("p_brand").alias("aisle_id"),
            department_of("p_type").alias("department_id"),
            F.lit("product").alias("type"),
        )

    def bronze_aisles(self, complete: bool = True) -> DataFrame:
        """Each aisle once per part; aisle 13 stays away unless ``complete``."""
        aisles = self.table("part").select(
            aisle_of("p_brand").alias("aisle_id"),
            F.col("p_brand").alias("aisle"),
            F.lit("aisle").alias("type"),
        )
        return aisles if complete else aisles.filter(F.col("aisle_id") != "13")

    def bronze_departments(self) -> DataFrame:
        return self.table("part").select(
            department_of("p_type").alias("department_id"),
            F.col("p_type").alias("department"),
            F.lit("department").alias("type"),
        )

    def catalog_events(self) -> DataFrame:
        """JSON bodies of all three types, with unknown types and malformed text."""
        key = F.col("p_partkey").cast("string")
        as_json = F.to_json(
            F.struct(
                F.when(F.col("p_partkey") % 9 == 0, "store")
                .when(F.col("p_partkey") % 4 == 0, "aisle")
                .when(F.col("p_partkey") % 4 == 1, "department")
                .otherwise("product")
                .alias("type"),
                key.alias("product_id"),
            )
        )
        body = F.when(F.col("p_partkey") % 17 == 0, F.concat(F.lit("{bad "), key))
        return self.table("part").select(body.otherwise(as_json).alias("body"))

    # ---- order events -------------------------------------------------------

    def order_events(self, with_arrival: bool = False) -> DataFrame:
        """Purchases: every fourth twice, every fiftieth without a readable time."""
        k = F.get_json_object("props", "$.k").cast("int")
        purchases = self.table("events").filter(F.col("event_type") == "purchase")
        twice = _sent_twice(purchases, F.col("event_id") % 4 == 0).withColumn("k", k)
        iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
        columns = [
            F.when(F.col("event_id") % 50 == 0, "bad").otherwise(iso).alias("event_time"),
            F.col("event_id").cast("int").alias("order_id"),
            F.col("user_id").cast("int").alias("user_id"),
            F.when(F.col("k") % 10 == 0, F.array().cast("array<int>"))
            .otherwise(F.array(F.col("k"), (F.col("k") + 7) % 100))
            .alias("product_ids"),
            F.lit("stream").alias("source"),
        ]
        if with_arrival:
            columns.append(F.date_format("ts", "yyyy-MM-dd").alias("arrived"))
        return twice.select(*columns)


    def differing_events(self) -> DataFrame:
        """Purchases sent again by other users, some a day earlier, in four parts by no order."""
        k = F.get_json_object("props", "$.k").cast("int")
        copies = F.concat(
            F.array(_copy(0, 0)),
            F.when(F.col("event_id") % 3 == 0, F.array(_copy(1, 1))).otherwise(F.array().cast(COPIES)),
            F.when(F.col("event_id") % 5 == 0, F.array(_copy(0, -1))).otherwise(F.array().cast(COPIES)),
        )
        purchases = self.table("events").filter(F.col("event_type") == "purchase")
        each = purchases.withColumn("k", k).select("*", F.inline(copies))
        return each.select(
            F.date_format(F.col("ts") - F.make_dt_interval("days"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("event_time"),
            F.col("event_id").cast("int").alias("order_id"),
            (F.col("user_id") + F.col("user")).cast("int").alias("user_id"),
            F.array(F.col("k"), F.col("k") + F.col("days")).alias("product_ids"),
            F.lit("stream").alias("source"),
            F.pmod(F.xxhash64("event_id", "user"), F.lit(4)).alias("part"),
        )


def _numbered_by_user(source: DataFrame) -> DataFrame:
    """Adds ``number``, ``n_total`` and ``gap``; rows without a day or id come last, as in the order of blocks."""
    user = Window.partitionBy("user_id")
    in_order = user.orderBy(F.col("day").asc_nulls_last(), F.col("order_id").asc_nulls_last())
    return (
        source.withColumn("number", F.row_number().over(in_order))
        .withColumn("n_total", F.count(F.lit(1)).over(user))
        .withColumn("gap", F.datediff("day", F.lag("day").over(user.orderBy("day", "order_id"))))
    )


COPIES = "array<struct<days:int,user:int>>"


def _copy(days: int, user: int) -> Column:
    return F.struct(F.lit(days).alias("days"), F.lit(user).alias("user"))


def product_of(part_key: str) -> Column:
    return F.expr(f"{part_key} div {PARTS_PER_PRODUCT}").cast("int")


def aisle_of(brand: str) -> Column:
    return F.replace(F.col(brand), F.lit("Brand#"), F.lit(""))


def department_of(part_type: str) -> Column:
    return (F.ascii(part_type) * 100 + F.length(part_type)).cast("string")


def _sent_twice(df: DataFrame, condition: Column) -> DataFrame:
    copies = F.when(condition, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")
