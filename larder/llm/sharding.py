"""Shards of nearly equal bytes by a minimax contiguous partition.

Equal texts form a group, which is never split. Groups are ordered by their
smallest id; the smallest capacity for which a greedy cut needs no more than the
given number of shards is found by binary search. No shard is larger; within that bound the
cuts fall next to even shares, as a greedy cut would fill the first shards and leave
little to the last.

The groups' sizes never come to the driver. It sees sums of up to 65,536 blocks of
consecutive groups. These give a lower and an upper bound of the capacity, and with
them the blocks in which a cut can lie; only those are read again in finer blocks,
until bounds meet. The result is the exact minimax cut.

Defined results: a NULL text counts as empty (no bytes, checksum 0); a group whose
ids are all NULL comes first; repeated rows are rows of their group.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.storage import Scratch

SHARDS = 24
BLOCKS = 1 << 16
ROW_BYTES = 8


def numbered_groups(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Rows without their texts, and groups with ``stop``: all bytes up to the group's end in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = scratch.stage(
        docs.select(
            F.col("doc_id").cast("long"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            # Written down, so it stays the same if a later step runs again.
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"))
    ordered = scratch.stage(
        groups.repartitionByRange(F.col("first").asc_nulls_first(), "digest")
        .sortWithinPartitions(F.col("first").asc_nulls_first(), "digest")
        .mapInArrow(_running, "digest binary, bytes long, part int, inside long"),
        "ordered",
    )
    # One row per partition of the sort.
    sums = {r.part: r.bytes for r in ordered.groupBy("part").agg(F.max("inside").alias("bytes")).collect()}
    before, total = {}, 0
    for part in sorted(sums):
        before[part] = total
        total += sums[part]
    spark = docs.sparkSession
    offsets = spark.createDataFrame(list(before.items()), "part int, before long")
    stops = ordered.join(F.broadcast(offsets), "part").select(
        "digest", "bytes", (F.col("before") + F.col("inside")).alias("stop")
    )
    return rows, scratch.stage(stops, "stops")


def _running(batches):
    from pyspark import TaskContext

    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        sums = np.cumsum(batch.column("bytes").to_numpy()) + total
        total = int(sums[-1]) if len(sums) else total
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), batch.column("bytes"), pa.array(np.full(len(sums), part, np.int32)), pa.array(sums)],
            ["digest", "bytes", "part", "inside"],
        )


class Outline:
    """What the driver knows: stops of some groups, and which spans between them hold several groups."""

    def __init__(self):
        self.stops: list[int] = [0]
        self.whole: list[bool] = [True]  # the span that ends here is a single group

    def add(self, blocks) -> None:
        """Blocks are (first stop, last stop, size of the first group)."""
        known = dict(zip(self.stops, self.whole))
        for first, last, size in blocks:
            known.setdefault(first - size, False)
            known[first] = True
            if last != first:
                known.setdefault(last, False)
        self.stops = sorted(known)
        self.whole = [known[s] for s in self.stops]
        self.whole[0] = True

    def cuts(self, capacity: int, shards: int, hopeful: bool, start: int = 0) -> list[int] | None:
        """Greedy ends of the shards from ``start`` on, or None if they do not suffice.

        Not hopeful: cuts fall only on known stops. Hopeful: also anywhere inside a
        span of several groups.
        """
        ends, at, total = [], start, self.stops[-1]
        while at < total:
            if len(ends) == shards:
                return None
            k = bisect_right(self.stops, at + capacity) - 1
            end = self.stops[k]
            if hopeful and k + 1 < len(self.stops) and not self.whole[k + 1]:
                end = at + capacity
            if end <= at:
                return None
            ends.append(end)
            at = end
        return ends

    def least(self, shards: int, hopeful: bool) -> int:
        low, high = max(1, -(-self.stops[-1] // shards)), max(1, self.stops[-1])
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hopeful) is None:
                low = middle + 1
            else:
                high = middle
        return low


    def large_groups(self, shards: int) -> list[tuple[int, int]]:
        """(start, stop) of the groups that are larger than an even share of what they leave to the others."""
        spans = [(a, b) for a, b, whole in zip(self.stops, self.stops[1:], self.whole[1:]) if whole]
        spans.sort(key=lambda s: s[0] - s[1])
        large, left = [], self.stops[-1]
        for start, stop in spans[: shards - 1]:
            if (stop - start) * (shards - len(large)) <= left:
                break
            large.append((start, stop))
            left -= stop - start
        return sorted(large)

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Ends of shards of like size, none above ``capacity``, which a greedy cut can keep.

        Each cut falls on the known stop nearest to an even share of what is left, as
        long as the rest can still be cut. A large group is a shard of its own where
        that leaves shards for the others, and does not count for their shares.
        """
        ends, at, total = [], 0, self.stops[-1]
        large = self.large_groups(shards)
        while at < total:
            left = shards - len(ends)
            ahead = [(a, b) for a, b in large if a >= at]
            small = total - at - sum(b - a for a, b in ahead)
            share = max(1, small / max(1, left - len(ahead)))
            # Up to the next large group, or past it: a whole number of shards of like size.
            edge = total if not ahead else ahead[0][0] if ahead[0][0] > at else ahead[0][1]
            if ahead and ahead[0][0] == at:
                want = edge
            else:
                want = at + (edge - at) / max(1, round((edge - at) / share))
            furthest = bisect_right(self.stops, at + capacity) - 1
            k = min(bisect_right(self.stops, want), furthest)
            near = sorted({max(k - 1, 0), k, furthest}, key=lambda i: abs(self.stops[i] - want))
            for i in near:
                end = self.stops[i]
                if at < end <= at + capacity and self.cuts(capacity, left - 1, False, end) is not None:
                    break
            else:
                end = self.stops[furthest]
            ends.append(end)
            at = end
        return ends


def minimax_cuts(stops: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS) -> list[int]:
    """The ends of the shards on the line of all bytes."""
    total = stops.agg(F.max("stop")).first()[0] or 0
    outline = Outline()
    if not total:
        return []
    spans = [(0, total)]
    while True:
        wide = sum(b - a for a, b in spans)
        width = max(1, wide // blocks)
        inside = F.lit(False)
        for a, b in spans:
            inside |= F.col("stop").between(a + 1, b)
        parts = (
            stops.filter(inside)
            .groupBy(F.floor((F.col("stop") - 1) / width).alias("block"))
            .agg(F.min(F.struct("stop", "bytes")).alias("first"), F.max("stop").alias("last"))
        )
        outline.add([(r["first"].stop, r["last"], r["first"].bytes) for r in parts.collect()])
        low, high = outline.least(shards, True), outline.least(shards, False)
        if low == high:
            return outline.even_cuts(high, shards)
        spans = _open_spans(outline, low, high, shards)


def _open_spans(outline: Outline, low: int, high: int, shards: int) -> list[tuple[int, int]]:
    """Spans of several groups in which a cut can lie, for any capacity between the bounds."""
    ends = outline.stops
    earliest = _furthest(outline, low, shards, False)
    latest = _furthest(outline, high, shards, True)
    wanted = set()
    for a, b in zip(earliest, latest):
        for k in range(max(1, bisect_left(ends, a)), min(len(ends), bisect_right(ends, b) + 2)):
            if not outline.whole[k]:
                wanted.add(k)
    spans: list[tuple[int, int]] = []
    for k in sorted(wanted):
        if spans and spans[-1][1] == ends[k - 1]:
            spans[-1] = (spans[-1][0], ends[k])
        else:
            spans.append((ends[k - 1], ends[k]))
    return spans


def _furthest(outline: Outline, capacity: int, shards: int, hopeful: bool) -> list[int]:
    """The k-th cut for this capacity, without asking whether the shards suffice."""
    ends, at = [], 0
    for _ in range(shards):
        k = bisect_right(outline.stops, at + capacity) - 1
        end = outline.stops[k]
        if hopeful and k + 1 < len(outline.stops) and not outline.whole[k + 1]:
            end = at + capacity
        at = max(at, end)
        ends.append(at)
    return ends


def sharded(docs: DataFrame, scratch: Scratch, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each document."""
    rows, stops = numbered_groups(docs, scratch)
    cuts = minimax_cuts(stops, shards)
    ends = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    shard = F.size(F.filter(ends, lambda c: c < F.col("stop"))).cast("int")
    placed = rows.join(stops.select("digest", shard.alias("shard")), "digest")
    order = ["shard", F.col("doc_id").asc_nulls_first(), "text_crc32", "row"]
    numbered = scratch.stage(
        placed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "size", "text_crc32", "shard")
        .mapInArrow(_numbered, "doc_id long, size long, text_crc32 long, shard int, part int, inside long"),
        "numbered",
    )
    # A partition of the sort holds few shards, so this is about a row per partition.
    counts = numbered.groupBy("shard", "part").agg(F.count("*").alias("n")).collect()
    before, at = [], {}
    for r in sorted(counts, key=lambda r: (r.shard, r.part)):
        before.append((r.shard, r.part, at.get(r.shard, 0)))
        at[r.shard] = at.get(r.shard, 0) + r.n
    offsets = docs.sparkSession.createDataFrame(before, "shard int, part int, before long")
    return numbered.join(F.broadcast(offsets), ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("inside")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _numbered(batches):
    from pyspark import TaskContext

    part, last, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        inside = np.zeros(len(shard), np.int64)
        starts = np.flatnonzero(np.diff(shard, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(shard)]):
            count = count if shard[a] == last else 0
            inside[a:b] = np.arange(count, count + b - a)
            count += int(b - a)
            last = shard[a]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(shard), part, np.int32)), pa.array(inside)],
            [*batch.schema.names, "part", "inside"],
        )
