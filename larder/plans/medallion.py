"""The whole batch run, Bronze folders to Silver and Gold tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators.contract import Contract
from larder.operators.metrics import auc_by_rank, confusion
from larder.operators.quality import split_by_reason
from larder.plans import model, silver
from larder.plans.gold import user_product_features
from larder.sources import tables as t
from larder.sources.storage import Scratch

log = logging.getLogger(__name__)


# Integer keys without which a row of a table is set aside, if that is asked for.
KEYS = {
    "orders": ("order_id", "user_id"),
    "order_products": ("order_id", "product_id"),
    "order_products_train": ("order_id", "product_id"),
    "products": ("product_id",),
}


def set_aside_bad_keys(rows: DataFrame, name: str, folder: str, scratch: Scratch) -> DataFrame:
    """The rows with readable keys; the others are written to ``folder`` as they came.

    Done on the raw rows, before copies are dropped, so each bad row is kept and
    counted for itself. The raw files are read once: what goes on is read from the
    stored rows, which also spread what came from files that cannot be split.
    """
    found = F.concat_ws(", ", *[F.when(F.col(k).try_cast("int").isNull(), f"{k} is no id") for k in KEYS[name]])
    good, bad = split_by_reason(rows.withColumn("reason", F.nullif(found, F.lit(""))), scratch)
    t.write_table(bad, f"{folder}/{name}")
    return good


def clean_and_write(
    name: str,
    sources: Sequence[DataFrame],
    clean: Callable[..., DataFrame],
    path: str,
    contract: Contract,
    rejected: str | None = None,
) -> int:
    """Clean, check and write one table; log rows read, return rows written (A4, K2)."""
    read, written = clean_and_count(name, sources, clean, path, contract, rejected)
    found = ", ".join("unknown" if n is None else str(n) for n in read)
    log.info("%s: %s rows read, %d rows written", name, found, written)
    return written


def clean_and_count(
    name: str,
    sources: Sequence[DataFrame],
    clean: Callable[..., DataFrame],
    path: str,
    contract: Contract,
    rejected: str | None = None,
) -> tuple[list[int | None], int]:
    """``clean_and_write`` with the rows read of each source (A4), and the rows written (K2).

    With ``rejected``, rows of the first source without readable keys go to that folder.

    Rows read are observed during the same job. They are for the log only: a task
    before a shuffle that has to run again counts its rows again.
    """
    scratch = Scratch(sources[0].sparkSession)
    try:
        if rejected:
            sources = [set_aside_bad_keys(sources[0], name, rejected, scratch), *sources[1:]]
        seen = [Observation() for _ in sources]
        counted = [df.observe(o, F.count(F.lit(1)).alias("rows")) for df, o in zip(sources, seen)]
        written = t.write_checked(clean(*counted), path, contract)
    finally:
        scratch.remove()
    return [_observed_rows(o) for o in seen], written


def _observed_rows(seen: Observation) -> int | None:
    """Rows observed; None where Spark skipped the source, its result being empty."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return None


def build_silver(
    spark: SparkSession, root: str, header: bool = True, reject_bad_keys: bool = False
) -> dict[str, int]:
    """Read, clean, check and write every Silver table; rows written per table.

    ``reject_bad_keys`` sets rows without readable keys aside below ``silver_rejected``
    instead of stopping the run on them.

    The first broken contract stops the run; tables written before it stay.
    Train labels are optional and pass the same check as the order lines.
    """
    orders, lines, products = (
        Contract.named(f"silver/{name}") for name in ("orders", "order_products", "products")
    )
    aside = f"{root}/silver_rejected" if reject_bad_keys else None
    rows = {
        "orders": clean_and_write(
            "orders",
            [t.read_bronze_orders(spark, root, header)],
            silver.clean_orders,
            f"{root}/{t.SILVER_ORDERS}",
            orders,
            aside,
        ),
        "order_products": clean_and_write(
            "order_products",
            [t.read_bronze_order_products(spark, root, header)],
            silver.clean_order_products,
            f"{root}/{t.SILVER_ORDER_PRODUCTS}",
            lines,
            aside,
        ),
        "products": clean_and_write(
            "products",
            [
                t.read_bronze_products(spark, root),
                t.read_bronze_aisles(spark, root),
                t.read_bronze_departments(spark, root),
            ],
            silver.build_products,
            f"{root}/{t.SILVER_PRODUCTS}",
            products,
            aside,
        ),
    }
    train = t.read_bronze_order_products_train(spark, root, header)
    if train is None:
        log.warning("order_products_train: no source, skipped")
    else:
        rows["order_products_train"] = clean_and_write(
            "order_products_train",
            [train],
            silver.clean_order_products,
            f"{root}/{t.SILVER_ORDER_PRODUCTS_TRAIN}",
            lines,
            aside,
        )
    return rows


def silver_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``orders``, ``order_products``, ``products`` or ``order_products_train``."""
    contract = "order_products" if name == "order_products_train" else name
    return t.read_table(spark, f"{root}/silver/{name}", Contract.named(f"silver/{contract}"))


def build_gold(spark: SparkSession, root: str) -> int:
    """Derive, check and write the feature table; rows written."""
    scratch = Scratch(spark)
    try:
        features = user_product_features(
            silver_table(spark, root, "orders"),
            silver_table(spark, root, "order_products"),
            silver_table(spark, root, "products"),
            scratch,
        )
        contract = Contract.named("gold/user_product_features")
        return t.write_checked(features, f"{root}/{t.GOLD_FEATURES}", contract)
    finally:
        scratch.remove()


def build_predictions(
    spark: SparkSession, root: str, k: int = model.DEFAULT_TOP, rounds: int = 20
) -> dict[str, float]:
    """Train on train users, save the model, write test users' recommendations.

    Returns AUC and F1 on the validation users, and the users written.
    """
    scratch = Scratch(spark)
    try:
        features = t.read_table(
            spark, f"{root}/{t.GOLD_FEATURES}", Contract.named("gold/user_product_features")
        )
        orders = silver_table(spark, root, "orders")
        train_lines = silver_table(spark, root, "order_products_train")
        labelled = scratch.stage(model.training_set(features, orders, train_lines, scratch), "labelled")
        fitted = model.fit(labelled.filter("NOT is_validation"), scratch, rounds)
        model.save(fitted, f"{root}/{t.GOLD_MODEL}")
        validation = scratch.stage(
            model.score(fitted, labelled.filter("is_validation")), "validation"
        )
        scored = model.score(fitted, model.candidates(features, orders, "test", scratch))
        users = t.write_checked(
            model.recommend(scored, k),
            f"{root}/{t.GOLD_PREDICTIONS}",
            Contract.named("gold/predictions"),
        )
        return {
            "auc": auc_by_rank(validation, "score", "label").first()["auc"],
            "f1": confusion(validation, "score", "label", 0.5).first()["f1"],
            "users": users,
        }
    finally:
        scratch.remove()
