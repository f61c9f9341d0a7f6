"""Data-quality rules over whole tables.

Every rule here counts rows or keys. Keys are counted before they are compared,
so a key with very many rows crosses the network once per input task.

Unlike contract rules, the range and membership rules of this module treat NULL
as a violation unless ``null_passes`` is set.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.storage import Scratch


def has_exactly(df: DataFrame, columns: Iterable[str]) -> bool:
    """V6: the column set equals ``columns``."""
    return set(df.columns) == set(columns)


def has_all(df: DataFrame, columns: Iterable[str]) -> bool:
    """V6: the column set contains ``columns``."""
    return set(columns) <= set(df.columns)


def _breaks(holds: Column, null_passes: bool) -> Column:
    return ~F.coalesce(holds, F.lit(null_passes))


def not_null(column: str) -> Column:
    """True where the column is NULL."""
    return F.col(column).isNull()


def not_between(column: str, low: Any, high: Any, null_passes: bool = False) -> Column:
    """True where the value is outside ``low..high``."""
    return _breaks(F.col(column).between(low, high), null_passes)


def below(column: str, low: Any, null_passes: bool = False) -> Column:
    """True where the value is smaller than ``low``."""
    return _breaks(F.col(column) >= low, null_passes)


def not_in(column: str, allowed: Sequence[Any], null_passes: bool = False) -> Column:
    """True where the value is none of ``allowed``."""
    return _breaks(F.col(column).isin(list(allowed)), null_passes)


def longer_than(column: str, length: int) -> Column:
    """True where the text is longer than the declared length."""
    return F.coalesce(F.length(column) > length, F.lit(False))


def count_broken(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, as (rule, violations), in one aggregate."""
    names = list(rules)
    counted = df.agg(*[F.count_if(rules[n]).alias(f"rule_{i}") for i, n in enumerate(names)])
    entries = [
        F.struct(F.lit(n).alias("rule"), F.col(f"rule_{i}").alias("violations"))
        for i, n in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*entries)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, with their number of child rows.

    A NULL foreign key is an orphan. Both sides are reduced to distinct keys
    before the anti join.
    """
    used = child.groupBy(F.col(fk).alias(fk)).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(pk).alias(fk)).distinct()
    return used.join(known, fk, "left_anti")


def split_rows(df: DataFrame, rules: Mapping[str, Column], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with the first broken rule as ``reason``.

    Rows are marked and written once, each kind to a folder of its own, so ``df`` is
    computed once and each result reads its own rows only.
    """
    reason = F.lit(None).cast("string")
    for name, broken in reversed(list(rules.items())):
        reason = F.when(broken, F.lit(name)).otherwise(reason)
    return split_by_reason(df.withColumn("reason", reason), scratch)


def split_by_reason(marked: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``reason`` is NULL, without it, and the others, from one pass."""
    path = scratch.path(f"split-{uuid.uuid4().hex}")
    marked.withColumn("_refused", F.col("reason").isNotNull()).write.partitionBy("_refused").parquet(path)
    schema = T.StructType([*marked.schema.fields, T.StructField("_refused", T.BooleanType())])
    stored = scratch.spark.read.schema(schema).parquet(path)
    accepted = stored.filter(~F.col("_refused")).drop("_refused", "reason")
    return accepted, stored.filter("_refused").drop("_refused")


def drop_null_keys(df: DataFrame, keys: Sequence[str], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys present, and the rest with a reason."""
    return split_rows(df, {f"{k} is NULL": not_null(k) for k in keys}, scratch)


def reconcile(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Compare two (table_name, n) row counts; a missing table counts 0."""
    left = source.select("table_name", F.col("n").alias("source_rows"))
    right = landed.select("table_name", F.col("n").alias("landed_rows"))
    joined = left.join(right, "table_name", "full").fillna(0, ["source_rows", "landed_rows"])
    return joined.withColumn("diff", F.col("landed_rows") - F.col("source_rows"))
