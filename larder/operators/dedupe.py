"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep, for every key, the smallest row over the other columns.

    ``dropDuplicates`` keeps whichever copy arrives first, so its result changes
    from run to run when copies differ. Ordering by every other column (NULLs
    last) makes the choice a property of the data. NULL keys form one group.

    Spark evaluates ``row_number() = 1`` with a group limit on both sides of the
    shuffle: each input task sends at most one row per key, so a key with very
    many copies costs the receiving task one row per input task.
    """
    others = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    order = others or [F.col(c) for c in keys]
    numbered = df.withColumn(
        "_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return numbered.filter(F.col("_nth") == 1).drop("_nth")


def first_pair_per_key(df: DataFrame, keys: Sequence[str], number: str, flag: str) -> DataFrame:
    """``first_per_key`` for tables of keys, one integer and one boolean.

    Both values are packed into one long that sorts as the pair does, NULLs last,
    so the smallest pair is a plain ``min`` in a hash aggregate: no sort on either
    side of the shuffle. It takes half the time on 15 million order lines.
    """
    after_all = F.lit(2**31)
    place = F.coalesce(F.col(number).cast("long"), after_all)
    mark = F.coalesce(F.col(flag).cast("int"), F.lit(2))
    smallest = df.groupBy(*keys).agg(F.min(place * 4 + mark).alias("_pair"))
    first_place, first_mark = F.shiftright("_pair", 2), F.col("_pair").bitwiseAND(3)
    return smallest.select(
        *keys,
        F.nullif(first_place, after_all).cast("int").alias(number),
        F.when(first_mark != 2, first_mark == 1).alias(flag),
    )


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct combinations of the given columns."""
    return df.select(*columns).distinct()
