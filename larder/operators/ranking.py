"""Top rows per group (W3, L1) and their list form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of every group, with their ``rank``.

    The limit is applied before the shuffle as well as after it, so a group of
    any size sends at most ``k`` rows per input task.
    """
    ranked = df.withColumn(
        "rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    )
    return ranked.filter(F.col("rank") <= k)


def ranked_lists(top: DataFrame, group: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Turn the ``top_k`` rows of a group into parallel arrays in rank order."""
    entries = F.sort_array(F.collect_list(F.struct("rank", *columns)))
    listed = top.groupBy(*group).agg(entries.alias("_entries"))
    return listed.select(
        *group,
        *[F.col("_entries").getField(src).alias(dst) for src, dst in columns.items()],
    )
