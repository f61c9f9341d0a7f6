"""Bounded samples of labelled rows, to fit small models on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Documented bound: classifiers are fitted on at most so many labelled documents.
FIT_ROWS = 20_000


def id_remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id counts as empty text."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def bounded(rows: DataFrame, key: Column, most: int, total: int) -> DataFrame:
    """At most ``most`` of ``total`` rows, those with the smallest hashes of ``key``.

    Few more than ``most`` rows leave their tasks, however many tasks there are, and
    which ones stay does not depend on the order in which tasks end.
    """
    cells = 1 << 30
    if total > most:
        # Four standard deviations more than are wanted, so that as good as always enough are there.
        share = (most + 4 * most**0.5 + 4) / total
        rows = rows.filter(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(cells)) < int(share * cells) + 1)
    order = [F.pmod(F.xxhash64(key, F.lit(7)), F.lit(cells)), key]
    return rows.orderBy(*order).limit(most)


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int = FIT_ROWS) -> DataFrame:
    """(label, text) of up to ``rows`` labelled documents, chosen by a hash of their id.

    Of several labels of a document the largest counts. The chosen ids, at most
    ``rows`` pairs of numbers, are broadcast; texts are not shuffled.
    """
    chosen = (
        labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("label", "text")
