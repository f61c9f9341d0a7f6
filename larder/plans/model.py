"""Reorder model: labels, split, training, scoring."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.operators.ranking import ranked_lists, top_k
from larder.operators.running import block_offsets
from larder.plans.gold import of_set
from larder.sources import versions
from larder.sources.storage import Scratch

NUMERIC_FEATURES = (
    "order_count",
    "reorder_rate",
    "avg_cart_position",
    "days_since_last_order",
    "user_total_orders",
    "product_popularity",
)
NAME_FEATURES = ("aisle_name", "department_name")
VALIDATION_FOLDS = 5
# Parts of the training users; a pair's name rates come from the other parts.
RATE_FOLDS = 4
DEFAULT_TOP = 10
SEED = 7
# A name counts as much as this many pairs with the overall rate, beside its own.
SMOOTHING = 20.0
# Parts into which the trees cut each feature, and distinct values that are placed in one task.
BINS = 32
RANGE_VALUES = 65_536
# Spark's trees take their split points from a sample unless the square of ``maxBins``, a 32-bit number, covers all rows.
MOST_BINS = 46_340


def train_purchases(orders: DataFrame, train_lines: DataFrame) -> DataFrame:
    """Distinct (user, product) pairs bought in train orders."""
    buyers = of_set(orders, "train").select("order_id", "user_id")
    bought = train_lines.select("order_id", "product_id").join(buyers, "order_id")
    return bought.select("user_id", "product_id").distinct()


def candidates(features: DataFrame, orders: DataFrame, eval_set: str, scratch: Scratch | None = None) -> DataFrame:
    """Known pairs of the users whose last order is in ``eval_set``.

    The users go to the pairs as bits, 64 neighbouring ids to a row. With ``scratch``
    these rows are stored first: Spark then knows how few they are, and need not
    shuffle the much larger pairs to find their users.
    """
    bit = F.expr("shiftleft(1L, cast(user_id & 63 as int))")
    users = of_set(orders, eval_set).groupBy(F.shiftright("user_id", 6).alias("_ids")).agg(F.bit_or(bit).alias("_bits"))
    if scratch:
        users = scratch.stage(users, f"users/{eval_set}-{uuid4().hex}")
    met = features.join(users, F.shiftright(features["user_id"], 6) == users["_ids"])
    return met.filter(F.col("_bits").bitwiseAND(bit) != 0).select(*features.columns)


def training_set(
    features: DataFrame, orders: DataFrame, train_lines: DataFrame, scratch: Scratch | None = None
) -> DataFrame:
    """Candidates of train users with label and validation flag.

    Validation takes whole users, so no user is on both sides. ``scratch`` as for ``candidates``.
    """
    bought = train_purchases(orders, train_lines).withColumn("label", F.lit(1))
    labelled = candidates(features, orders, "train", scratch).join(
        bought, ["user_id", "product_id"], "left"
    )
    return labelled.withColumn("label", F.coalesce("label", F.lit(0))).withColumn(
        "is_validation", F.pmod("user_id", F.lit(VALIDATION_FOLDS)) == 0
    )


def fold_of(user: str = "user_id") -> Column:
    """The fold of a training user; all pairs of a user are in one. Unknown users are in fold 0."""
    part = F.floor(F.col(user) / VALIDATION_FOLDS)
    return F.coalesce(F.pmod(part, F.lit(RATE_FOLDS)), F.lit(0)).cast("int")


def name_rates(training: DataFrame) -> DataFrame:
    """(feature, name, fold, rate): smoothed shares of reordered pairs of each name.

    Names become numbers by what is known of them, at any number of names and without
    bringing them to the driver. A row with a fold leaves that fold's pairs out: it is
    for the pairs of the fold itself, whose labels must not be in their own features. A
    row without one counts all pairs, for pairs outside the training set. Rows without
    a name are the overall rates, which stand for names not seen (outside the fold).

    The training set is read once: pairs are counted per name and fold, and everything
    else comes from those counts.
    """
    features = F.array(
        F.struct(F.lit(None).cast("string").alias("feature"), F.lit(None).cast("string").alias("name")),
        *[F.struct(F.lit(f).alias("feature"), F.col(f).alias("name")) for f in NAME_FEATURES],
    )
    each = training.select(fold_of().alias("fold"), "label", F.inline(features))
    counts = (
        each.filter(F.col("feature").isNull() | F.col("name").isNotNull())
        .groupBy("feature", "name", "fold")
        .agg(F.sum("label").alias("s"), F.count("*").alias("n"))
    )
    # One row of the whole name, and of the name without each of its folds; folds are few.
    by_name = counts.groupBy("feature", "name").agg(
        F.sum("s").alias("all_s"), F.sum("n").alias("all_n"), F.collect_list(F.struct("fold", "s", "n")).alias("folds")
    )
    without = F.transform(
        F.col("folds"),
        lambda f: F.struct(f.fold.alias("fold"), (F.col("all_s") - f.s).alias("s"), (F.col("all_n") - f.n).alias("n")),
    )
    whole = F.struct(F.lit(None).cast("int").alias("fold"), F.col("all_s").alias("s"), F.col("all_n").alias("n"))
    kept = by_name.select("feature", "name", F.inline(F.concat(F.array(whole), without)))
    # Overall rates: one row a fold. A fold that is all there is has nothing beside it, and rate 0.
    share = F.coalesce(F.try_divide(F.col("s"), F.col("n")), F.lit(0.0))
    overall = {
        r["fold"]: r["rate"] for r in kept.filter("feature IS NULL").select("fold", share.alias("rate")).collect()
    }
    if not overall:
        overall = {None: 0.0}
    spark = training.sparkSession
    plain = spark.createDataFrame(
        [(None, None, f, float(r)) for f, r in overall.items()], "feature string, name string, fold int, rate double"
    )
    base = F.lit(float(overall[None]))
    for fold, rate in overall.items():
        if fold is not None:
            base = F.when(F.col("fold") == fold, F.lit(float(rate))).otherwise(base)
    smoothed = (F.col("s") + SMOOTHING * base) / (F.col("n") + SMOOTHING)
    return plain.unionByName(kept.filter("feature IS NOT NULL").select("feature", "name", "fold", smoothed.alias("rate")))


@dataclass
class ReorderModel:
    """M3, M4, M7: trees over six numbers, and the rates of names beside them."""

    trees: PipelineModel
    rates: DataFrame


def with_rates(rows: DataFrame, rates: DataFrame, in_training: bool = False) -> DataFrame:
    """A ``<name>_rate`` column per name feature; unseen and NULL names get the overall rate.

    ``in_training`` takes the rates without the row's own fold, and no others.
    """
    fold = fold_of() if in_training else F.lit(None).cast("int")
    overall = {r["fold"]: r["rate"] for r in rates.filter("feature IS NULL").collect()}
    base = F.lit(float(overall.get(None, 0.0)))
    for number, rate in overall.items():
        if number is not None:
            base = F.when(F.col("_fold") == number, F.lit(float(rate))).otherwise(base)
    rows = rows.withColumn("_fold", fold)
    for feature in NAME_FEATURES:
        one = rates.filter((F.col("feature") == feature) & (F.col("fold").isNotNull() == F.lit(in_training)))
        one = one.select(
            F.col("name").alias(feature), F.col("fold").alias("_of"), F.col("rate").alias(f"{feature}_rate")
        )
        on = [rows[feature] == one[feature]]
        if in_training:
            on.append(rows["_fold"] == one["_of"])
        rows = rows.join(one, on, "left").drop(one[feature]).drop("_of")
        rows = rows.withColumn(f"{feature}_rate", F.coalesce(f"{feature}_rate", base))
    return rows.drop("_fold")


def cut_points(
    rows: DataFrame, features: Sequence[str], scratch: Scratch, bins: int = BINS, range_values: int = RANGE_VALUES
) -> dict[str, list[float]]:
    """Where each feature is cut into at most ``bins`` parts of about equal size, by all rows.

    Cuts lie between neighbouring distinct values, and between all of them if these are
    no more than ``bins``. Rows are counted per value, and values are placed in ranges
    of about ``range_values``, so no task holds all values of a feature. Only the ends
    of the parts reach the driver. NULL and NaN are left out.
    """
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    counts = rows.select(F.inline(each)).filter("value IS NOT NULL AND NOT isnan(value)").groupBy("feature", "value")
    name = f"values-{uuid4().hex}"
    stored = scratch.stage(counts.agg(F.count("*").alias("n")), name)
    ranges = max(1, -(-stored.count() // range_values))
    dealt = stored.repartitionByRange(ranges, "feature", "value").withColumn("_block", F.spark_partition_id())
    ranged = scratch.stage(dealt, f"{name}-ranges").withColumn("one", F.lit(1).cast("long"))
    blocks = ranged.groupBy("feature", "_block").agg(F.sum("n").alias("n"), F.sum("one").alias("one"))
    offsets = block_offsets(blocks, ["feature"], ["_block"], ["n", "one"])
    inside = Window.partitionBy("feature", "_block").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = [F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_below") for c in ("n", "one")]
    placed = ranged.select("feature", "_block", "value", *below).join(offsets, ["feature", "_block"])
    place = F.when(F.col("one_total") <= bins, F.col("one_before") + F.col("one_below")).otherwise(
        F.floor((F.col("n_before") + F.col("n_below")) * F.lit(float(bins)) / F.col("n_total"))
    )
    parts = placed.groupBy("feature", place.alias("part")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    ends: dict[str, list[tuple[float, float]]] = {f: [] for f in features}
    for row in parts.orderBy("feature", "part").collect():
        ends[row["feature"]].append((row["low"], row["high"]))
    for done in (name, f"{name}-ranges"):
        scratch.drop(done)
    cuts = {}
    for feature, parts_of in ends.items():
        cuts[feature] = []
        for (_, high), (low, _) in zip(parts_of, parts_of[1:]):
            middle = high / 2 + low / 2
            cuts[feature].append(min(middle if high < middle <= low else low, sys.float_info.max))
    return cuts


def fit(training: DataFrame, scratch: Scratch, rounds: int = 20, depth: int = 5) -> ReorderModel:
    """M3, M4: gradient-boosted trees, on all pairs. Rates, split points and trees come from every row."""
    rates = scratch.stage(name_rates(training), "name_rates")
    columns = [*NUMERIC_FEATURES, *[f"{c}_rate" for c in NAME_FEATURES]]
    rated = with_rates(training, rates, in_training=True)
    cuts = cut_points(rated, columns, scratch)
    # A feature of one value has no cut; Spark asks for one.
    ends = [[-math.inf, *(cuts[c] or [0.0]), math.inf] for c in columns]
    bins = Bucketizer(
        splitsArray=ends, inputCols=columns, outputCols=[f"{c}_bin" for c in columns], handleInvalid="error"
    )
    assembler = VectorAssembler(
        inputCols=[f"{c}_bin" for c in columns],
        outputCol="features",
        handleInvalid="error",
    )
    # Features have few values now, so the limit on bins costs nothing, and Spark finds the bins in all rows.
    whole = math.isqrt(training.count()) + 1
    trees = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        maxIter=rounds,
        maxDepth=depth,
        maxBins=min(max(BINS, whole), MOST_BINS),
        checkpointInterval=5,
        seed=SEED,
    )
    return ReorderModel(Pipeline(stages=[bins, assembler, trees]).fit(rated), rates)


def save(model: ReorderModel, path: str) -> None:
    """M7: trees and rates become the current model together, or not at all."""
    spark = model.rates.sparkSession
    with versions.run_of(spark, path) as run:
        folder = versions.run_folder(path, run)
        model.trees.write().save(f"{folder}/trees")
        model.rates.write.parquet(f"{folder}/rates")
        versions.replace(spark, path, run, 0)


def load(spark: SparkSession, path: str) -> ReorderModel:
    """M7"""
    (folder,) = versions.live_folders(path, versions.current(spark, path))
    return ReorderModel(PipelineModel.load(f"{folder}/trees"), spark.read.parquet(f"{folder}/rates"))


def score(model: ReorderModel, rows: DataFrame) -> DataFrame:
    """Probability that the user buys the product again, as ``score``, unrounded."""
    scored = model.trees.transform(with_rates(rows, model.rates))
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("score"))


def recommend(scored: DataFrame, k: int = DEFAULT_TOP) -> DataFrame:
    """Per user the ``k`` best products and their scores."""
    best = top_k(
        scored.select("user_id", "product_id", "score"),
        ["user_id"],
        [F.col("score").desc(), F.col("product_id")],
        k,
    )
    return ranked_lists(
        best, ["user_id"], {"product_id": "recommended_product_ids", "score": "scores"}
    )
