"""Catalog events routed to Bronze folders by type and arrival date (T5, K7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.plans.landing import accepted_events, parse_catalog_events, rejected_events
from larder.sources.storage import Scratch


def read_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """One event body per line of the text files in ``folder``."""
    lines = spark.readStream.option("recursiveFileLookup", True).text(folder)
    return lines.withColumnRenamed("value", "body")


class CatalogSink:
    """Writes one micro-batch, parsed and stored once: accepted bodies by type and date, and rejected ones.

    All of a batch lies in folders with its number, which a rerun writes anew, so
    nothing is landed twice. Each task writes its own rows; they are not gathered by
    type, since nearly all events are products. The body is written as it came, so
    fields that no contract names are kept.
    """

    def __init__(self, folder: str, rejected: str, arrived_at: Column):
        self.folder, self.rejected, self.arrived_at = folder, rejected, arrived_at

    def __call__(self, bodies: DataFrame, number: int) -> None:
        scratch = Scratch(bodies.sparkSession)
        try:
            parsed = scratch.stage(parse_catalog_events(bodies, self.arrived_at), "parsed")
            routed = accepted_events(parsed).withColumn("batch", F.lit(number))
            write = routed.select("body", "type", "year", "month", "day", "batch").write
            write = write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
            write.partitionBy("type", "year", "month", "day", "batch").text(self.folder)
            rejected_events(parsed).write.mode("overwrite").json(f"{self.rejected}/batch={number}")
        finally:
            scratch.remove()


def land_catalog_events(
    bodies: DataFrame, folder: str, rejected: str, checkpoint: str, arrived_at: Column
) -> StreamingQuery:
    """T5, K7: start one stream over all input there is, with accepted and rejected events as its outputs."""
    sink = CatalogSink(folder, rejected, arrived_at)
    return (
        bodies.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted bodies with type and arrival date."""
    return spark.read.text(folder).withColumnRenamed("value", "body").drop("batch")
