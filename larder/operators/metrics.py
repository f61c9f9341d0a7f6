"""Quality of a scored, labelled set."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.running import block_offsets
from larder.sources.storage import Scratch

# Results are rounded to this many decimals; scores never are.
RESULT_DECIMALS = 6
# Distinct scores that are added up in one task.
RANGE_SCORES = 65_536


def auc_by_rank(df: DataFrame, score: str, label: str, range_scores: int = RANGE_SCORES) -> DataFrame:
    """Exact AUC-ROC by the rank formula; ties count half.

    Rows are first counted per distinct score, and the counts are stored: ``df`` is
    computed once. A running sum over all scores would end in one task, so scores are
    dealt into ranges of about ``range_scores``, as many as that takes, and the sum is
    taken inside them and then over their totals. Rows without a score or label, or
    with a score that is no number, do not count. The job runs when this is called.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession)
    value = F.col(score).cast("double")
    positive = (F.col(label) == 1).cast("long")
    try:
        histogram = scratch.stage(
            df.filter(value.isNotNull() & ~F.isnan(value) & F.col(label).isNotNull())
            .groupBy(value.alias("_score"))
            .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")),
            "histogram",
        )
        ranges = -(-histogram.count() // range_scores)
        if ranges > 1:
            # Stored again with the number of the range, which both levels then read.
            dealt = histogram.repartitionByRange(ranges, "_score")
            histogram = scratch.stage(dealt.withColumn("_block", F.spark_partition_id()), "ranges")
        else:
            histogram = histogram.withColumn("_block", F.lit(0))
        result = _auc(histogram)
        return spark.createDataFrame(result.collect(), result.schema)  # one row
    finally:
        scratch.remove()


def _auc(ranged: DataFrame) -> DataFrame:
    """AUC from counts per score, with ``_block`` rising with the score."""
    sums = [F.sum(c).alias(c) for c in ("pos", "neg")]
    totals = ranged.groupBy("_block").agg(*sums).withColumn("_all", F.lit(0))
    offsets = block_offsets(totals, ["_all"], ["_block"], ["pos", "neg"])
    inside = Window.partitionBy("_block").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    counted = ranged.select("_block", "pos", "neg", below.alias("below")).join(
        offsets.select("_block", "neg_before"), "_block"
    )
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("below") + F.col("neg") / 2))
    positives = F.coalesce(F.sum("pos"), F.lit(0))
    negatives = F.coalesce(F.sum("neg"), F.lit(0))
    return counted.agg(
        positives.alias("positives"),
        negatives.alias("negatives"),
        F.round(F.try_divide(wins, positives.cast("double") * negatives), RESULT_DECIMALS).alias(
            "auc"
        ),
    )


def confusion(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """Confusion counts and F1 at a fixed threshold, in one aggregate.

    Rows without a score or label are in no cell.
    """
    said = F.col(score) >= threshold
    true = F.col(label) == 1
    counts = df.agg(
        F.count_if(said & true).alias("tp"),
        F.count_if(said & ~true).alias("fp"),
        F.count_if(~said & true).alias("fn"),
        F.count_if(~said & ~true).alias("tn"),
    )
    hits = 2 * F.col("tp")
    f1 = F.try_divide(hits.cast("double"), hits + F.col("fp") + F.col("fn"))
    return counts.withColumn("f1", F.round(f1, RESULT_DECIMALS))
