"""Times the headline jobs on the given tables and prints one JSON line.

BENCH_SF_DIR names the folder of given tables, BENCH_CPUS the local cores.
The Bronze folders are landed first, from the given tables; each later job reads
what the job before it stored, as in a real run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.compare import local_session  # noqa: E402
from checks.queries import Lake, stream_events_silver  # noqa: E402
from larder.operators.contract import Contract  # noqa: E402
from larder.operators.metrics import auc_by_rank  # noqa: E402
from larder.plans import gold, medallion, model, silver  # noqa: E402
from larder.sources import tables as t  # noqa: E402


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def count_rule_by_rule(contract: Contract, df) -> None:
    """One job per rule: what the fused check is compared with."""
    for rule in contract.value_rules(df):
        df.filter(rule.broken).count()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    run_all(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    lake = Lake(spark, folder)
    root = lake.scratch.root
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28} {seconds[name]:8.3f}s", file=sys.stderr, flush=True)
        return result

    def stored(name):
        return medallion.silver_table(spark, root, name)

    timed("land_orders_and_lines", lake.land_orders)
    timed("land_catalog", lambda: lake.land_catalog(complete=True))
    timed("silver_orders", lambda: rows.update(orders=t.write_checked(
        silver.clean_orders(t.read_bronze_orders(spark, root)),
        f"{root}/{t.SILVER_ORDERS}", Contract.named("silver/orders"))))
    timed("silver_order_products", lambda: rows.update(order_products=t.write_checked(
        silver.clean_order_products(t.read_bronze_order_products(spark, root)),
        f"{root}/{t.SILVER_ORDER_PRODUCTS}", Contract.named("silver/order_products"))))
    timed("silver_products", lambda: rows.update(products=t.write_checked(
        silver.build_products(
            t.read_bronze_products(spark, root), t.read_bronze_aisles(spark, root),
            t.read_bronze_departments(spark, root)),
        f"{root}/{t.SILVER_PRODUCTS}", Contract.named("silver/products"))))
    timed("silver_train_labels", lambda: rows.update(train=t.write_checked(
        silver.clean_order_products(t.read_bronze_order_products_train(spark, root)),
        f"{root}/{t.SILVER_ORDER_PRODUCTS_TRAIN}", Contract.named("silver/order_products"))))
    timed("gold_features", lambda: rows.update(features=medallion.build_gold(spark, root)))
    orders, lines, products = stored("orders"), stored("order_products"), stored("products")
    contract = Contract.named("silver/orders")
    timed("contract_one_aggregate", lambda: contract.check(orders))
    timed("contract_job_per_rule", lambda: count_rule_by_rule(contract, orders))
    timed("user_order_timeline", lambda: run_all(gold.user_timeline(orders)))
    timed("user_product_stats", lambda: run_all(gold.user_product_stats(orders, lines)))
    timed("department_reorder_rate", lambda: run_all(
        gold.department_reorder_rate(orders, lines, products)))
    features = t.read_table(
        spark, f"{root}/{t.GOLD_FEATURES}", Contract.named("gold/user_product_features"))
    scored = features.withColumnRenamed("order_count", "score")
    timed("topk_recommendations", lambda: run_all(model.recommend(scored)))
    labelled = model.training_set(features, orders, stored("order_products_train"))
    timed("auc_by_rank", lambda: auc_by_rank(labelled, "reorder_rate", "label").collect())
    timed("order_event_stream", lambda: run_all(stream_events_silver(spark, folder)))
    silver_seconds = sum(s for name, s in seconds.items() if name.startswith("silver_"))
    silver_rows = sum(n for name, n in rows.items() if name != "features")
    per_rule = seconds.pop("contract_job_per_rule")
    print(json.dumps({
        "metric": "total seconds of the headline jobs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "rows": rows,
        "silver_rows_per_second": round(silver_rows / silver_seconds),
        "contract_job_per_rule": per_rule,
        "contract_speedup": round(per_rule / seconds["contract_one_aggregate"], 2),
    }))


if __name__ == "__main__":
    main()
