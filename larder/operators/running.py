"""Running totals and totals per group that stay parallel inside one group.

A plain ``sum().over(partitionBy(user))`` puts all rows of a user in one task.
Here the ordering column is cut into blocks of ``2**BLOCK_BITS`` consecutive
values. Rows of a block are summed in their own task; a second, much smaller
window runs over the block totals of the group. Both windows are bounded by the
32-bit ordering column: at most 65,536 points in a block, and at most 65,536
blocks in a group, however many rows the group has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16


def block_of(order: str, bits: int = BLOCK_BITS) -> Column:
    return F.shiftright(F.col(order), bits)


def block_offsets(
    blocks: DataFrame,
    group: Sequence[str],
    by: Sequence[str],
    measures: Sequence[str],
) -> DataFrame:
    """For one row per (group, block): what lies before the block, and in all.

    Adds ``<m>_before`` and ``<m>_total`` for each measure and drops ``<m>``.
    """
    whole = Window.partitionBy(*group)
    in_order = [F.col(c).asc_nulls_last() for c in by]
    before = whole.orderBy(*in_order).rowsBetween(Window.unboundedPreceding, -1)
    added = []
    for m in measures:
        zero = F.lit(0).cast(blocks.schema[m].dataType)
        added.append(F.coalesce(F.sum(m).over(before), zero).alias(f"{m}_before"))
        added.append(F.sum(m).over(whole).alias(f"{m}_total"))
    kept = [c for c in blocks.columns if c not in measures]
    return blocks.select(*kept, *added)


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    measures: Mapping[str, Column],
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """One row per (group, order) with ``<m>_running`` and ``<m>_total``.

    Rows that tie on ``order`` share one running value (SQL RANGE semantics), so
    they are added up before any window sees them. ``order`` is an integer
    column. A row without an order has no running value, and counts only in its
    group's total; a row without a group key has neither.
    """
    group = list(group)
    sums = [F.sum(column).alias(name) for name, column in measures.items()]
    # One key of both, so that nothing is inferred about NULLs on one side of the join only:
    # both levels start from the points' shuffle, which Spark makes once.
    key = F.struct(*group, block_of(order, bits).alias("_block"))
    points = df.groupBy(*group, order).agg(*sums).withColumn("_key", key)
    blocks = points.groupBy("_key").agg(*[F.sum(m).alias(m) for m in measures]).select("*", "_key.*")
    offsets = block_offsets(blocks, group, ["_block"], list(measures))
    inside = Window.partitionBy("_key").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = points.select(*group, order, "_key", *[F.sum(m).over(inside).alias(m) for m in measures])
    in_group = F.lit(True)
    for c in group:
        in_group &= F.col(c).isNotNull()
    placed = in_group & F.col(order).isNotNull()
    added = offsets.select("_key", *[f"{m}_{w}" for m in measures for w in ("before", "total")])
    return local.join(added, "_key", "left").select(
        *group,
        order,
        *[F.when(placed, F.col(f"{m}_before") + F.col(m)).alias(f"{m}_running") for m in measures],
        *[F.when(placed, F.col(f"{m}_total")).alias(f"{m}_total") for m in measures],
    )
