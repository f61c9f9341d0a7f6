"""Landing into Bronze: catalog events (C8) and the full load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators.quality import reconcile
from larder.sources.tables import is_missing_path, read_stored, write_table

# The catalog event types that are accepted.
EVENT_TYPES = ("aisle", "department", "product")
# Reasons for which an event is rejected.
INVALID_JSON = "invalid_json"
INVALID_TYPE = "invalid_type"


# ---- catalog events ---------------------------------------------------------


def parse_catalog_events(events: DataFrame, arrived_at: Column) -> DataFrame:
    """Add type, reason, status and arrival date parts.

    ``body`` must be one JSON object; it is kept whole, on one line. An absent
    body counts as an empty object. Wrapping it in an array makes text after
    the object an error.
    """
    body = F.coalesce(F.nullif(F.trim("body"), F.lit("")), F.lit("{}"))
    wrapped = F.concat(F.lit("["), body, F.lit("]"))
    objects = F.from_json(wrapped, "array<struct<type:string>>", {"allowSingleQuotes": "false"})
    first = F.try_element_at(objects, F.lit(1))
    valid = (F.size(objects) == 1) & first.isNotNull()
    kind = first.getField("type")
    reason = F.when(~F.coalesce(valid, F.lit(False)), INVALID_JSON).when(
        ~F.coalesce(kind.isin(*EVENT_TYPES), F.lit(False)), INVALID_TYPE
    )
    return events.select(
        # A line break in valid JSON can only be white space between tokens.
        F.translate(body, "\r\n", "  ").alias("body"),
        F.when(~F.coalesce(reason == INVALID_JSON, F.lit(False)), kind).alias("type"),
        reason.alias("reason"),
        F.when(reason.isNull(), "ok").otherwise("failed").alias("status"),
        F.year(arrived_at).alias("year"),
        F.month(arrived_at).alias("month"),
        F.dayofmonth(arrived_at).alias("day"),
    )


def accepted_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason", "status")


def rejected_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("body", "type", "reason")


def event_counts(parsed: DataFrame) -> DataFrame:
    """Accepted and failed events per type; unreadable ones have type NULL."""
    return parsed.groupBy("type", "status").agg(F.count(F.lit(1)).alias("n"))


def catalog_records(rows: DataFrame, event_type: str) -> DataFrame:
    """Catalog rows as event bodies of one type, ids as text."""
    fields = [F.col(c).cast("string").alias(c) for c in rows.columns if c != "type"]
    return rows.select(F.to_json(F.struct(*fields, F.lit(event_type).alias("type"))).alias("body"))


# ---- full load --------------------------------------------------------------


def land_full_load(
    tables: Mapping[str, DataFrame], folder: str, loaded_at: Column, header: bool = True
) -> dict[str, int]:
    """Write each source table as gzip CSV with a load timestamp; rows written per table.

    The rows keep the source's partitions: one file per key range read. Texts may
    hold line breaks; they are quoted, and readers take records over several lines.
    """
    written = {}
    for name, df in tables.items():
        seen = Observation()
        stamped = df.withColumn("load_ts", loaded_at).observe(seen, F.count(F.lit(1)).alias("rows"))
        writer = stamped.write.mode("overwrite").option("header", header)
        writer.option("escape", '"').option("compression", "gzip").csv(f"{folder}/{name}")
        written[name] = seen.get["rows"]
    return written


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, n) row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionAll(count)
    return total


def reconcile_load(
    spark: SparkSession, written: Mapping[str, int], folder: str, header: bool = True
) -> DataFrame:
    """Rows observed while landing against rows found in the landed files.

    The source is not read again: it may have changed since.
    """
    reader = spark.read.option("header", header).option("escape", '"').option("multiLine", True)
    landed = {name: reader.csv(f"{folder}/{name}") for name in written}
    loaded = spark.createDataFrame(list(written.items()), "table_name string, n long")
    return reconcile(loaded, table_counts(landed))


def is_populated(spark: SparkSession, path: str) -> bool:
    """The table exists and has a row."""
    try:
        return not read_stored(spark, path).isEmpty()
    except AnalysisException as error:
        if is_missing_path(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return False
        raise


def seed_table(df: DataFrame, path: str, force: bool = False) -> bool:
    """Load a table unless it has rows; ``force`` replaces them.

    Returns whether rows were loaded. Should the load fail, the rows before it stay.
    """
    if not force and is_populated(df.sparkSession, path):
        return False
    write_table(df, path)
    return True
