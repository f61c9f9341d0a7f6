"""A key with a large part of all rows is split over tasks."""

import re

import pytest
from pyspark.sql import functions as F

from larder.plans import gold, silver
from larder.sources import tables as t
from larder.sources.storage import Scratch
from tests.conftest import plan_of


@pytest.fixture
def small_partitions(settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="16KB",
    )


def final_plan(df):
    """The plan adaptive execution arrived at."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df)


def test_lookup_splits_a_hot_key(spark, small_partitions):
    # Rows are wide enough, and come from enough tasks, for a partition to be split.
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 97).cast("int").alias("aisle_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    aisles = silver.first_per_key(
        spark.range(97).selectExpr("int(id) AS aisle_id", "concat('a', id) AS aisle_name"), ["aisle_id"]
    )
    joined = silver.lookup(rows, aisles, "aisle_id")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60000 and joined.filter("aisle_name IS NULL").isEmpty()


def test_last_gold_join_splits_a_hot_product(spark, small_partitions):
    scratch = Scratch(spark)
    n = 40000
    orders = scratch.stage(
        spark.range(n).selectExpr(
            "int(id) AS order_id", "int(id) AS user_id", "'prior' AS eval_set", "1 AS order_number",
            "0 AS order_dow", "0 AS order_hour_of_day", "0.0D AS days_since_prior_order",
        ),
        "orders",
    )
    lines = scratch.stage(
        spark.range(0, n, 1, 8).selectExpr(
            "int(id) AS order_id", "int(IF(id % 3 = 0, 1, id % 500)) AS product_id",
            "1 AS add_to_cart_order", "false AS reordered",
        ),
        "lines",
    )
    products = scratch.stage(
        spark.range(500).selectExpr("int(id) AS product_id", "'a' AS aisle_name", "'d' AS department_name"),
        "products",
    )
    features = gold.user_product_features(orders, lines, products, scratch)
    assert "skew=true" in final_plan(features)
    hot = features.filter("product_id = 1").select("product_popularity").first()[0]
    assert hot == lines.filter("product_id = 1").count()
    assert features.count() == n


def test_running_totals_put_no_group_in_one_window(spark):
    orders = spark.range(10).selectExpr(
        "int(id) AS order_id", "int(id % 2) AS user_id", "'prior' AS eval_set",
        "int(id) AS order_number", "1.0D AS days_since_prior_order",
    )
    plan = plan_of(gold.user_timeline(orders))
    per_block, per_user = [], []
    for line in plan.splitlines():
        if " Window [" in line:
            (per_block if re.search(r"\], \[_key#\d+\]", line) else per_user).append(line)
    # Points are ordered within a block; only block totals are ordered within a user.
    assert per_block and all("order_number" in line for line in per_block)
    assert per_user and not any("order_number" in line for line in per_user)


def test_a_hot_bucket_is_written_by_several_tasks(spark, settings, tmp_path):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__shuffle__partitions="100",
    )
    df = spark.range(0, 60000, 1, 8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 100).alias("bucket"),
    )
    assert t.write_table(df, str(tmp_path / "t"), ["bucket"]) == 60000
    assert len(list((tmp_path / "t").glob("run=*/bucket=1/*.parquet"))) > 3
    # An ordinary bucket is one or two files, not one per input task.
    assert len(list((tmp_path / "t").glob("run=*/bucket=50/*.parquet"))) <= 2


def test_a_small_table_is_one_file(spark, tmp_path):
    t.write_table(spark.range(0, 1000, 1, 8), str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("run=*/*.parquet"))) == 1
