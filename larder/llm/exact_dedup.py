"""Exact duplicates by a minimal perfect hash over the digests of earlier texts.

The distinct digests of earlier documents are cut into parts of about 200,000. Each
part gets a minimal perfect hash: levels of bit arrays, in which a key is placed
where no other key of its level falls; the rank of its bit is its slot. A slot
holds the full digest with the place of the winner and the number of copies. New
digests look up their slot and compare all 32 bytes: equal ones are repeats, the
others are grouped among themselves.

Only ids and digests are shuffled, added up per digest before they meet, so a text
that makes up a third of all rows costs one row per task.

Defined results: a NULL text counts as empty; of equal texts the largest ``doc_id``
stays (a NULL id only if all are NULL); repeated rows with that id all stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.text import mixed, string_parts
from larder.sources.storage import Scratch

PART_KEYS = 200_000
# Bits per key and level: more place more keys at once.
SPARE = 2
DIGEST_BYTES = 32
COUNTED = "digest binary, winner long, copies long"


def words_of(column: pa.Array) -> np.ndarray:
    return string_parts(column)[0].view(np.uint64).reshape(-1, DIGEST_BYTES // 8)


def level_hash(words: np.ndarray, level: int) -> np.ndarray:
    state = np.full(len(words), level + 1, np.uint64)
    for k in range(words.shape[1]):
        state = mixed(state + words[:, k])
    return state


def build_levels(words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of a minimal perfect hash of distinct keys, and each key's slot."""
    levels, slots = [], np.full(len(words), -1, np.int64)
    left, placed = np.arange(len(words)), 0
    while len(left):
        size = max(64, SPARE * len(left))
        place = (level_hash(words[left], len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        rank = np.cumsum(alone) - 1
        fits = alone[place]
        slots[left[fits]] = placed + rank[place[fits]]
        placed += int(alone.sum())
        levels.append(alone)
        left = left[~fits]
    return levels, slots


def find_slots(words: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot of every key; -1 for some keys that were never placed, any slot for others."""
    slots = np.full(len(words), -1, np.int64)
    left, before = np.arange(len(words)), 0
    for number, alone in enumerate(levels):
        place = (level_hash(words[left], number) % np.uint64(len(alone))).astype(np.int64)
        hit = alone[place]
        rank = np.cumsum(alone) - 1
        slots[left[hit]] = before + rank[place[hit]]
        before += int(alone.sum())
        left = left[~hit]
    return slots


def digests(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.unhex(F.sha2(text, 256)).alias("digest"))


def counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count("*").alias("copies"))


def build_index(history: DataFrame, parts: int) -> DataFrame:
    """One row per part: bit arrays, and the slots' digests, winners and copies in slot order."""

    def build(key, table):
        words = words_of(table.column("digest"))
        levels, slots = build_levels(words)
        order = pa.array(np.argsort(slots))
        sorted_rows = table.select(["digest", "winner", "copies"]).take(order)
        part, bits, sizes = key[0].as_py(), [np.packbits(a).tobytes() for a in levels], [len(a) for a in levels]
        # Nested per part, so that one row is one part of the index.
        return pa.table(
            {
                "part": pa.array([part], pa.int32()),
                "bits": pa.array([bits], pa.list_(pa.binary())),
                "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "digests": pa.array([sorted_rows.column("digest").to_pylist()], pa.list_(pa.binary())),
                "winners": pa.array([sorted_rows.column("winner").to_pylist()], pa.list_(pa.int64())),
                "copies": pa.array([sorted_rows.column("copies").to_pylist()], pa.list_(pa.int64())),
            }
        )

    schema = "part int, bits array<binary>, sizes array<long>, digests array<binary>, winners array<long>, copies array<long>"
    return history.withColumn("part", part_of(parts)).groupBy("part").applyInArrow(build, schema)


def part_of(parts: int):
    return F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int")


def resolve(index: DataFrame, batch: DataFrame, parts: int) -> DataFrame:
    """(digest, winner, copies) over the index and the new, counted digests."""

    def lookup(known, new):
        words = words_of(new.column("digest")) if new.num_rows else np.zeros((0, 4), np.uint64)
        if known.num_rows == 0:
            return new.select(["digest", "winner", "copies"])
        slots_digest = known.column("digests").combine_chunks().flatten()
        held = words_of(slots_digest)
        winners = known.column("winners").combine_chunks().flatten().to_pandas().astype("Int64")
        copies = known.column("copies").combine_chunks().flatten().to_numpy(zero_copy_only=False).copy()
        sizes = known.column("sizes")[0].as_py()
        packed = known.column("bits")[0].as_py()
        levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(packed, sizes)]
        slots = find_slots(words, levels)
        member = slots >= 0
        member[member] = (held[slots[member]] == words[member]).all(1)
        at = slots[member]
        copies[at] += new.column("copies").to_numpy()[member]
        theirs = new.column("winner").to_pandas().astype("Int64")[member]
        ours = winners.iloc[at].reset_index(drop=True)
        theirs = theirs.reset_index(drop=True)
        best = ours.where(theirs.isna() | (ours >= theirs).fillna(False), theirs)
        winners.iloc[at] = best.to_numpy()
        mine = pa.table(
            {
                "digest": slots_digest,
                "winner": pa.array(winners, pa.int64(), from_pandas=True),
                "copies": pa.array(copies, pa.int64()),
            }
        )
        others = new.select(["digest", "winner", "copies"]).filter(pa.array(~member))
        return pa.concat_tables([mine, others.cast(mine.schema)])

    grouped = batch.withColumn("part", part_of(parts)).groupBy("part")
    return index.groupBy("part").cogroup(grouped).applyInArrow(lookup, COUNTED)


def exact_duplicates(history: DataFrame, batch: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per document of both: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = scratch.stage(
        digests(history).withColumn("old", F.lit(True)).union(digests(batch).withColumn("old", F.lit(False))), "digests"
    )
    earlier = scratch.stage(counted(rows.filter("old")), "earlier")
    added = scratch.stage(counted(rows.filter("NOT old")), "added")
    # By whichever is larger: nonmembers meet in the same parts as the index.
    parts = 1 + max(earlier.count(), added.count()) // PART_KEYS
    index = scratch.stage(build_index(earlier, parts), "index")
    groups = resolve(index, added, parts)
    return rows.join(groups, "digest").select(
        "doc_id",
        F.col("winner").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("winner")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
