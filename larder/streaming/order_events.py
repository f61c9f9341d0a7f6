"""Order events from Bronze to Silver.

No event is too late, and neither their order nor the cut into batches changes Silver:
of all copies of an order ever seen, the smallest event stays, in the order of
``first_per_key``. A later batch that brings a smaller copy replaces the rows written
before, also those under another date.

Beside Silver stands a store of the event kept per order. It is cut into blocks of
1,048,576 consecutive order numbers, and a batch reads and rewrites only the blocks it has
numbers of, so its work follows the batch and not the stream's age. With smaller
blocks, a batch of scattered numbers opens, writes and deletes very many files. A store goes on with the blocks it was begun with. Both are versioned
tables that note the batch they hold, so a batch that is run again changes nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import event_instant, utc_date
from larder.operators.contract import Contract
from larder.operators.dedupe import first_per_key
from larder.sources import versions
from larder.sources.storage import Scratch

# What decides between copies, and is kept of an order.
EVENT = ("event_ts", "event_time", "user_id", "product_ids", "source")
BLOCK_BITS = 20
# Of stores that do not note theirs.
FIRST_BLOCK_BITS = 16
# Runs of one level and date that are merged into one run of the next level.
FAN = 8
# Versions of Silver whose files stay, for readers that began some batches ago.
READERS_BEHIND = 10


def read_order_events(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """JSON files, gzip or not, in any depth of dated folders."""
    reader = spark.readStream.schema(Contract.named("bronze/stream").schema())
    reader = reader.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(folder)


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable events with ``event_ts``; the rest with a ``reason``.

    Events without a time or an order id would pass through de-duplication
    unmatched, so they are set aside before it.
    """
    timed = events.withColumn("event_ts", event_instant("event_time"))
    reason = F.when(F.col("event_ts").isNull(), "unreadable event_time").when(
        F.col("order_id").isNull(), "no order_id"
    )
    marked = timed.withColumn("reason", reason)
    good = marked.filter(F.col("reason").isNull()).drop("reason")
    bad = marked.filter(F.col("reason").isNotNull())
    return good, bad.select("event_time", "order_id", "user_id", "product_ids", "source", "reason")


def explode_products(events: DataFrame) -> DataFrame:
    """One row per product with its position in the cart.

    An event without products stays, as one row with NULL product and position.
    """
    return events.select(
        "event_ts",
        "order_id",
        "user_id",
        F.posexplode_outer("product_ids").alias("_at", "product_id"),
        "source",
    ).select(
        "event_ts",
        "order_id",
        "user_id",
        (F.col("_at") + 1).alias("position"),
        "product_id",
        "source",
        utc_date(F.col("event_ts")).alias("event_date"),
    )


# ---- which event of an order stays ----------------------------------------------


def block_of(bits: int, order_id: str = "order_id") -> Column:
    return F.shiftright(order_id, bits)


def bits_of(store: versions.Version) -> int:
    """By how many bits the blocks of a store are cut."""
    return store.notes.get("bits", FIRST_BLOCK_BITS if store.number else BLOCK_BITS)


def in_order(prefix: str = "") -> Column:
    """An event as a value that sorts as ``first_per_key`` does, NULLs last."""
    return F.struct(*[x for c in EVENT for x in (F.isnull(f"{prefix}{c}"), F.col(f"{prefix}{c}"))])


def changes(fresh: DataFrame, kept: DataFrame) -> DataFrame:
    """The events that are new or smaller than the one kept, with that one's date as ``old_date``.

    ``fresh`` has one event per order, ``kept`` likewise.
    """
    before = kept.select("order_id", *[F.col(c).alias(f"kept_{c}") for c in EVENT])
    both = fresh.join(before.withColumn("is_kept", F.lit(True)), "order_id", "left")
    changed = both.filter(F.col("is_kept").isNull() | (in_order() < in_order("kept_")))
    return changed.select("order_id", *EVENT, utc_date(F.col("kept_event_ts")).alias("old_date"))


def first_events(events: DataFrame) -> DataFrame:
    """One event per order id. Copies are reduced in every task before they meet."""
    return first_per_key(events.select("order_id", *EVENT), ["order_id"])


# ---- the sink ---------------------------------------------------------------------


def date_part(date) -> str:
    return f"event_date={date}"


def block_part(block: int) -> str:
    return f"block={block}"


def store_schema() -> T.StructType:
    types = {f.name: f.spark_type for f in Contract.named("bronze/stream").fields}
    schema = T.StructType().add("order_id", types["order_id"])
    for c in EVENT:
        schema = schema.add(c, T.TimestampType() if c == "event_ts" else types[c])
    return schema


class BatchSink:
    """Brings one micro-batch into Silver, the store of kept events, and the rejected events.

    Silver is published first and the store last, each with the batch's number, so a
    batch that failed in between finds what it has done.
    """

    def __init__(self, folder: str, rejected: str, state: str):
        self.folder, self.rejected, self.state = folder, rejected, state

    def __call__(self, events: DataFrame, number: int) -> None:
        spark = events.sparkSession
        store = versions.current(spark, self.state)
        if store.notes.get("batch", -1) >= number:
            return
        scratch = Scratch(spark)
        try:
            # Parsed once for all outputs.
            good, bad = split_events(scratch.stage(events, "events"))
            bad.write.mode("overwrite").json(f"{self.rejected}/batch={number}")
            fresh = scratch.stage(first_events(good).withColumn("block", block_of(bits_of(store))), "fresh")
            # At most 4,096 numbers: ids have 32 bits.
            blocks = [r["block"] for r in fresh.select("block").distinct().collect()]
            kept = self.kept(spark, blocks)
            changed = scratch.stage(changes(fresh, kept), "changed")
            self.into_silver(changed, number)
            self.into_store(changed, kept, number)
            merge_small_runs(spark, self.folder)
        finally:
            scratch.remove()

    def kept(self, spark: SparkSession, blocks: Iterable[int]) -> DataFrame:
        """The kept events of some blocks; no file of another block is opened."""
        return versions.read(spark, self.state, store_schema(), [block_part(b) for b in blocks])

    def into_silver(self, changed: DataFrame, number: int) -> None:
        """Rows of new orders join their dates as a run; dates that lose rows are written anew."""
        spark = changed.sparkSession
        before = versions.current(spark, self.folder)
        if before.notes.get("batch", -1) >= number:
            return
        contract = Contract.named("silver/stream_events")
        added = explode_products(changed)
        contract.require(added)
        # As many as there are dates.
        old = changed.filter(F.col("old_date").isNotNull()).select("old_date").distinct().collect()
        touched = [p for p in (date_part(r["old_date"]) for r in old) if p in before.parts]
        if touched:
            gone = changed.filter(F.col("old_date").isNotNull()).select("order_id")
            left = versions.read(spark, self.folder, contract.schema(), touched, before)
            added = added.unionByName(left.join(gone, "order_id", "left_anti"))
        parts = {p: runs for p, runs in before.parts.items() if p not in touched}
        with versions.run_of(spark, self.folder) as run:
            write_run(added, self.folder, run)
            for part in versions.partitions_of(spark, self.folder, run, 1):
                parts[part] = (*parts.get(part, ()), run)
            versions.publish(spark, self.folder, before.following(parts, batch=number), READERS_BEHIND)

    def into_store(self, changed: DataFrame, kept: DataFrame, number: int) -> None:
        """Blocks with changes are written anew, 1,048,576 events each at most."""
        spark = changed.sparkSession
        before = versions.current(spark, self.state)
        events, bits = changed.select("order_id", *EVENT), bits_of(before)
        same = kept.join(events.select("order_id"), "order_id", "left_anti")
        blocks = changed.select(block_of(bits).alias("block")).distinct()
        rows = same.withColumn("block", block_of(bits)).join(blocks, "block", "left_semi")
        rows = rows.unionByName(events.withColumn("block", block_of(bits)))
        with versions.run_of(spark, self.state) as run:
            rows.hint("rebalance", "block").write.partitionBy("block").parquet(versions.run_folder(self.state, run))
            parts = {p: (run,) for p in versions.partitions_of(spark, self.state, run, 1)}
            versions.publish(spark, self.state, before.following({**before.parts, **parts}, batch=number, bits=bits))


def write_run(rows: DataFrame, folder: str, run: str) -> None:
    rows.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(versions.run_folder(folder, run))


def level_of(run: str) -> int:
    return int(run.split("-")[0])


def merge_small_runs(spark: SparkSession, folder: str) -> None:
    """K4: where a date has ``FAN`` runs of a level, write them as one run of the next.

    So a date has fewer than ``FAN`` runs a level, and a row is written anew once a
    level: as often as the logarithm of the number of batches.
    """
    schema = Contract.named("silver/stream_events").schema()
    while True:
        before = versions.current(spark, folder)
        due = {
            (part, level)
            for part, runs in before.parts.items()
            for level, n in Counter(map(level_of, runs)).items()
            if n >= FAN
        }
        if not due:
            return
        level = min(level for _, level in due)
        parts = [part for part, of_level in due if of_level == level]
        small = {p: [r for r in before.parts[p] if level_of(r) == level] for p in parts}
        only_small = versions.Version(before.number, {p: tuple(r) for p, r in small.items()})
        with versions.run_of(spark, folder, level + 1) as run:
            write_run(versions.read(spark, folder, schema, version=only_small), folder, run)
            merged = {p: (*(r for r in before.parts[p] if r not in small[p]), run) for p in parts}
            versions.publish(spark, folder, before.following({**before.parts, **merged}), READERS_BEHIND)


def read_stream_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver rows of all batches, with the contract's columns."""
    return versions.read(spark, folder, Contract.named("silver/stream_events").schema())


def build_stream_silver(
    spark: SparkSession,
    source: str,
    folder: str,
    rejected: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> None:
    """Take all input there is, then return.

    A batch that breaks the contract of Silver ends the stream and leaves no rows.
    """
    events = read_order_events(spark, source, max_files_per_trigger)
    sink = BatchSink(folder, rejected, f"{checkpoint}/kept")
    query = (
        events.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{checkpoint}/query")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
