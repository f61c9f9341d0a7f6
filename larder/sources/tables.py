"""Bronze readers, and writers for every layer."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import bucket_of
from larder.operators.contract import Contract, ContractViolation
from larder.sources import versions

# Folders of each table below the lake's root.
BRONZE_ORDERS = "bronze/historical/public/orders"
BRONZE_ORDER_PRODUCTS = "bronze/historical/public/order_products"
BRONZE_ORDER_PRODUCTS_TRAIN = "bronze/historical/manual/order_products_train"
BRONZE_CATALOG = "bronze/api"
BRONZE_PRODUCTS = "bronze/api/{product,type=product}"
BRONZE_AISLES = "bronze/api/{aisle,type=aisle}"
BRONZE_DEPARTMENTS = "bronze/api/{department,type=department}"
BRONZE_STREAM = "bronze/stream"
SILVER_ORDERS = "silver/orders"
SILVER_ORDER_PRODUCTS = "silver/order_products"
SILVER_PRODUCTS = "silver/products"
SILVER_ORDER_PRODUCTS_TRAIN = "silver/order_products_train"
SILVER_STREAM_EVENTS = "silver/stream_events"
GOLD_FEATURES = "gold/user_product_features"
GOLD_MODEL = "models/reorder"
GOLD_PREDICTIONS = "gold/predictions"


# ---- readers ----------------------------------------------------------------


def read_csv(
    spark: SparkSession,
    path: str,
    contract: Contract,
    header: bool = True,
    spread: int | None = None,
) -> DataFrame:
    """CSV or CSV.gz as text columns of the contract; empty text is NULL.

    With a header, columns are taken by name, so extra columns and another order
    do no harm and a missing optional column is NULL. Files are read together with
    the others that have the same header line, since Spark applies one header by
    position to all files it reads. Without a header, the contract gives the names.
    No pass over the data infers types. Texts may hold line breaks; a large plain file
    whose records all end with their line is split among tasks, any other file is one
    task's. ``spread`` redistributes the rows afterwards where no later step does.
    """
    reader = spark.read.option("header", header).option("nullValue", "").option("escape", '"')
    if not header:
        whole = reader.option("multiLine", True).schema(contract.text_schema()).csv(path)
        df = declared_columns(whole, contract)
        return df.repartition(spread) if spread else df
    heads = file_heads(spark, path)
    if not heads:
        raise FileNotFoundError(f"no CSV file with a header at {path}")
    lines = files_of_lines(spark, [h for h in heads if h.size > split_bytes(spark) and not h.is_compressed])
    groups: dict[tuple[str, bool], list[str]] = {}
    for h in heads:
        groups.setdefault((h.line, h.file in lines), []).append(h.file)
    df = None
    for (line, ends_with_line), files in groups.items():
        columns = next(csv.reader([line]))
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        # A file whose header differs after all is an error, not a swap.
        one = reader.schema(schema).option("enforceSchema", False).option("multiLine", not ends_with_line).csv(files)
        part = declared_columns(one, contract)
        df = part if df is None else df.unionByName(part, allowMissingColumns=True)
    return df.repartition(spread) if spread else df


# Endings of files that Spark decompresses.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")


@dataclass(frozen=True)
class FileHead:
    file: str
    size: int
    line: str

    @property
    def is_compressed(self) -> bool:
        return self.file.lower().endswith(COMPRESSED)


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a file that one task reads at most, where files can be split."""
    return spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()


def file_heads(spark: SparkSession, path: str) -> list[FileHead]:
    """Size and first line of every file that has one, sorted by name.

    A task per file reads its first lines and no more. What comes to the driver is a
    line for each of the files, which it has to list in any case.
    """
    session = spark.newSession()
    # Above any file's size, so that no file is split and none shares a task.
    for key in ("maxPartitionBytes", "openCostInBytes"):
        session.conf.set(f"spark.sql.files.{key}", str(1 << 50))
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    lines = session.read.text(path).select("_metadata.file_path", "_metadata.file_size", "value")
    heads = lines.mapInArrow(first, "file string, size long, line string").collect()
    return sorted((FileHead(unquote(h["file"]), h["size"], h["line"]) for h in heads), key=lambda h: h.file)


def files_of_lines(spark: SparkSession, heads: Sequence[FileHead]) -> set[str]:
    """The files in which no record goes on after its line; they are read in pieces by many tasks.

    A record over several lines begins with a line that has an odd number of quotes.
    """
    files = [h.file for h in heads]
    if not files:
        return set()
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    broken = spark.read.text(files).filter(quotes % 2 == 1).select("_metadata.file_path").distinct()
    return set(files) - {unquote(r["file_path"]) for r in broken.collect()}


def declared_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns that ``df`` has, in order; optional ones as NULL."""
    present = {c.lower(): c for c in df.columns}
    columns: list[Column] = []
    for f in contract.fields:
        found = present.get(f.name.lower())
        if found is not None:
            columns.append(F.col(f"`{found}`").alias(f.name))
        elif f.nullable:
            columns.append(F.lit(None).cast("string").alias(f.name))
    return df.select(*columns)


def read_json(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """JSON records in any depth of dated folders, every column as text.

    The catalog folders match both ``product/`` and the ``type=product/`` that
    the landing stream writes.

    Ids may be quoted or not; declaring them as numbers would turn quoted ones
    into NULL without a word.
    """
    reader = spark.read.schema(contract.text_schema()).option("recursiveFileLookup", True)
    return reader.json(path)


def read_bronze_orders(spark: SparkSession, root: str, header: bool = True) -> DataFrame:
    """S1"""
    return read_csv(spark, f"{root}/{BRONZE_ORDERS}", Contract.named("bronze/orders"), header)


def read_bronze_order_products(spark: SparkSession, root: str, header: bool = True) -> DataFrame:
    """S2"""
    contract = Contract.named("bronze/order_products")
    return read_csv(spark, f"{root}/{BRONZE_ORDER_PRODUCTS}", contract, header)


def read_bronze_products(spark: SparkSession, root: str) -> DataFrame:
    """S3"""
    return read_json(spark, f"{root}/{BRONZE_PRODUCTS}", Contract.named("bronze/products"))


def read_bronze_aisles(spark: SparkSession, root: str) -> DataFrame:
    """S4"""
    return read_json(spark, f"{root}/{BRONZE_AISLES}", Contract.named("bronze/aisles"))


def read_bronze_departments(spark: SparkSession, root: str) -> DataFrame:
    """S5"""
    return read_json(spark, f"{root}/{BRONZE_DEPARTMENTS}", Contract.named("bronze/departments"))


def read_bronze_order_products_train(
    spark: SparkSession, root: str, header: bool = True
) -> DataFrame | None:
    """Train labels, or None when the folder is not there.

    Only a missing path and a folder without files are tolerated; unreadable data is
    an error.
    """
    contract = Contract.named("bronze/order_products")
    try:
        return read_csv(spark, f"{root}/{BRONZE_ORDER_PRODUCTS_TRAIN}", contract, header)
    except FileNotFoundError:
        return None
    except AnalysisException as error:
        if is_missing_path(error) or error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    low: int,
    high: int,
    parts: int,
    **options: str,
) -> DataFrame:
    """A database table read in ``parts`` key ranges at once."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("partitionColumn", key).option("numPartitions", parts)
    return reader.option("lowerBound", low).option("upperBound", high).options(**options).load()


def read_table(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """A Silver or Gold table, with its declared schema."""
    return read_stored(spark, path, contract.schema())


def read_stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table as the writers of this module publish it, or a plain folder of Parquet files."""
    if versions.is_versioned(spark, path):
        return versions.read(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def in_bucket(id_column: str, bucket_column: str, value: int) -> Column:
    """Find one id and read only its bucket's files."""
    return (F.col(bucket_column) == bucket_of(F.lit(value))) & (F.col(id_column) == value)


# ---- writers ----------------------------------------------------------------


def balanced(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Bring rows of a bucket together without tying a bucket to one task.

    The rebalance hint shuffles by bucket and lets adaptive execution split
    large buckets and merge small ones at the advisory partition size. A bucket
    with a third of all rows is written by many tasks, and a small table by one.
    """
    return df.hint("rebalance", *partition_by)


def _counted(df: DataFrame, contract: Contract | None) -> tuple[DataFrame, Observation]:
    """Observe the row count, and the contract's rules, while ``df`` is written.

    Observed above the last shuffle, so a task that runs again counts once.
    """
    seen = Observation()
    metrics = contract.rule_metrics(df) if contract else []
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    only_touched_partitions: bool = False,
) -> int:
    """K1, K2, K3, K8: replace a Parquet table and return the rows written.

    ``only_touched_partitions`` leaves buckets without new rows as they are.
    """
    return _replaced(df, path, partition_by, None, only_touched_partitions)["rows"]


def _replaced(
    df: DataFrame, path: str, partition_by: Sequence[str], contract: Contract | None, only_touched: bool
) -> dict[str, int]:
    """Write a run and publish it if it breaks no rule; what was observed in it."""
    spark = df.sparkSession
    out, seen = _counted(balanced(df, partition_by), contract)
    with versions.run_of(spark, path) as run:
        out.write.partitionBy(*partition_by).parquet(versions.run_folder(path, run))
        counts = seen.get
        broken = contract.broken_rules(df, counts) if contract else []
        if broken:
            raise ContractViolation(contract.name, broken)
        versions.replace(spark, path, run, len(partition_by), only_touched and bool(partition_by))
    return counts


def write_checked(
    df: DataFrame, path: str, contract: Contract, only_touched_partitions: bool = False
) -> int:
    """V5 with K1: write a table only if it keeps its contract.

    Rows are computed once: the rules are counted while the table goes to a run of
    its own, which is published, in one step, when no rule is broken. Otherwise it is
    deleted, ``path`` stays as it was, and ``ContractViolation`` is raised.
    ``only_touched_partitions`` replaces the buckets that ``df`` has rows for, all at
    once, and leaves the others.
    """
    broken = contract.schema_violations(df)
    if broken:
        raise ContractViolation(contract.name, broken)
    return _replaced(df, path, contract.partition_by, contract, only_touched_partitions)["rows"]
