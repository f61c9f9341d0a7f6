"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct runs of five words. Each set is reduced to
registers: a hash picks the register, and the smallest hash of a register is kept
as its count of leading zeros (6 bits) and the 10 bits that follow the first one.
Bands of four of 128 registers propose pairs; 256 finer registers give an estimate
of the similarity, corrected for registers that agree by chance; the remaining
pairs are confirmed on their full sets.

Defined results: NULL, empty or blank texts have no set and are linked with
nothing; texts of fewer than five words have their whole word sequence as only
element; rows with equal sets are linked; a NULL ``doc_id`` sorts after all others.
Repeated rows are in one group; ``near_duplicates`` marks all copies of its smallest id,
``one_of_each`` keeps one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.components import Spans, flagged, flags_of, linked_components, rows_alike
from larder.llm.text import (
    lower_ascii,
    mixed,
    shingle_hashes,
    slices,
    span_hashes,
    string_parts,
    word_bounds,
)
from larder.sources.storage import Scratch

WORDS = 5
REGISTER_BITS = 8
REGISTERS = 1 << REGISTER_BITS
MANTISSA = 10
BAND = 4
BANDS = 32
BAND_BITS = 7
# Pairs are dropped unconfirmed only this many standard deviations below the threshold.
SIGMAS = 5.0
# Words of parities that are compared at once.
PARITY_WORDS = 1 << 20
# Hash cells by which elements are ordered.
CELLS = 1 << 20


def word_sets(raw: np.ndarray, at: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text."""
    raw = lower_ascii(raw)
    starts, ends, before = word_bounds(raw, at)
    hashes = span_hashes(raw, starts, ends)
    for i in range(len(at) - 1):
        yield shingle_hashes(hashes[before[i] : before[i + 1]], words)


def registers_of(hashes: np.ndarray, bits: int = REGISTER_BITS) -> np.ndarray:
    """Registers of sorted hashes; 0 where none fell, else zeros and mantissa."""
    out = np.zeros(1 << bits, np.uint16)
    if not len(hashes):
        return out
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(slot, prepend=-1))
    rest = hashes[first] << np.uint64(bits)
    # Exact: a float64 exponent of a value with its low bits cleared cannot round up.
    exponent = np.frexp((rest & ~np.uint64(0xFFF)).astype(np.float64))[1]
    zeros = np.minimum(np.where(exponent > 0, 64 - exponent, 64), 62).astype(np.uint64)
    follow = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    # Stored so that 0 stays free for an empty register.
    out[slot[first]] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA) | follow).astype(np.uint16)
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key per band that holds anything."""
    bands = registers.reshape(BANDS, BAND).astype(np.uint64)
    packed = np.zeros(BANDS, np.uint64)
    for k in range(BAND):
        packed = packed << np.uint64(16) | bands[:, k]
    filled = packed != 0
    keys = mixed(packed + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return keys[filled].view(np.int64)


def chance_matches(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected number of registers in which two unrelated sets of these sizes agree."""
    total = np.zeros(np.broadcast(n, m).shape)
    for zeros in range(0, 63):
        low, high = (0.0, 2.0**-62) if zeros == 62 else (2.0 ** -(zeros + 1), 2.0**-zeros)
        # Within one exponent the 2**MANTISSA cells are nearly alike: the middle stands for all.
        width = (high - low) / 2**MANTISSA
        middle = (low + high) / 2
        inside = []
        for size in (n, m):
            load = size / REGISTERS
            inside.append(load * width * np.exp(-load * middle))
        total += 2**MANTISSA * inside[0] * inside[1]
    return total * REGISTERS


def corrected(same: np.ndarray, used: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from agreeing registers, without those expected to agree by chance."""
    chance = np.minimum(chance_matches(n, m), used)
    return np.clip((same - chance) / np.maximum(used - chance, 1e-9), 0.0, 1.0)


def register_bits(registers: np.ndarray) -> bytes:
    """One bit of each register's value: equal values have equal bits, others in half of the cases."""
    places = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(16)
    return np.packbits((mixed(registers.astype(np.uint64) + places) & np.uint64(1)).astype(bool)).tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, n_shingles, digest of the set, sketch (registers and size), coarse (their bits and size),
    parity (size and parities) and band keys."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                raw, at = string_parts(part.column("text"))
                sizes, digests, kept, coarse, parity, keys = [], [], [], [], [], []
                for hashes in word_sets(raw, at):
                    registers = registers_of(hashes)
                    sizes.append(len(hashes))
                    digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    size = len(hashes).to_bytes(8, "little")
                    kept.append(registers.tobytes() + size)
                    coarse.append(register_bits(registers) + size)
                    parity.append(size + parities(hashes))
                    keys.append(band_keys(registers_of(hashes, BAND_BITS)))
                counts = np.cumsum([0] + [len(k) for k in keys])
                flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(kept, pa.binary()),
                        pa.array(coarse, pa.binary()),
                        pa.array(parity, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(flat)),
                    ],
                    ["doc_id", "text_key", "n_shingles", "digest", "sketch", "coarse", "parity", "keys"],
                )

    columns = "doc_id long, text_key long, n_shingles long, digest binary, sketch binary, coarse binary, parity binary, keys array<long>"
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return keyed.mapInArrow(run, columns)


def few_bits_apart(threshold: float):
    """Nearness of coarse sketches; minus infinity for sizes too far apart, and for more bits than a pair at the threshold has apart."""
    share = (1 - threshold) / 2
    most = REGISTERS * share + SIGMAS * np.sqrt(REGISTERS * share * (1 - share)) + 2
    width = REGISTERS // 8

    def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, right = (np.ascontiguousarray(x[:, :width]).view(np.uint64) for x in (a, b))
        n, m = (np.ascontiguousarray(x[:, width:]).view(np.int64)[:, 0] for x in (a, b))
        apart = np.bitwise_count(left ^ right).sum(1)
        far = (np.minimum(n, m) < threshold * np.maximum(n, m) - 1e-9) | (apart > most)
        return np.where(far, -np.inf, -apart.astype(float))

    return score


def likely(threshold: float):
    """Estimated similarity of sketches; minus infinity where it is far below the threshold."""

    def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        width = 2 * REGISTERS
        left, right = (np.ascontiguousarray(x[:, :width]).view(np.uint16) for x in (a, b))
        n, m = (np.ascontiguousarray(x[:, width:]).view(np.int64)[:, 0].astype(float) for x in (a, b))
        n, m = np.broadcast_arrays(n, m)
        out = np.full(len(n), -np.inf)
        used = ((left != 0) | (right != 0)).sum(1)
        same = ((left == right) & (left != 0)).sum(1)
        # The correction only lowers an estimate, so the raw share decides first.
        some = same >= (threshold - margin(threshold, used)) * used
        some = np.flatnonzero(some & (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9))
        if len(some):
            near = corrected(same[some], used[some], n[some], m[some])
            out[some] = np.where(near >= threshold - margin(threshold, used[some]), near, -np.inf)
        return out

    return score


def margin(threshold: float, used):
    used = np.maximum(used, 1)
    return SIGMAS * np.sqrt(threshold * (1 - threshold) / used) + 2 / used


def rarest_elements(docs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch):
    """For the given sets, (key, id) rows of those elements one of which any linked sets must share.

    In whatever order elements are put, of n elements the first n - ceil(t n) + 1
    must meet those of a set that is similar to degree t. The order here is by how
    often an element's hash cell was seen in the given sets, rare ones first, so
    that what a family of copies has in common comes last. Only the counts of
    ``CELLS`` cells, a fixed number, come to the driver.
    """

    def found_in(part):
        return list(word_sets(*string_parts(part.column("text"))))

    def cells(batches):
        counts = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for hashes in found_in(part):
                    np.add.at(counts, (hashes % np.uint64(CELLS)).astype(np.int64), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["cell", "n"])

    def narrow(ids: DataFrame) -> DataFrame:
        wanted = sets.join(ids, "id", "left_semi").select("id", "digest", F.col("least").alias("doc_id"))
        texts = scratch.stage(texts_of(docs, scratch.stage(wanted, "open-wanted")), "open-texts")
        seen = texts.mapInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        often = np.zeros(CELLS, np.int32)
        often[seen.column("cell").to_numpy()] = np.minimum(seen.column("n").to_numpy(), 2**31 - 1)

        def first_elements(batches):
            for batch in batches:
                for part in slices(batch, "text"):
                    chosen = []
                    for hashes in found_in(part):
                        order = np.lexsort([hashes, often[(hashes % np.uint64(CELLS)).astype(np.int64)]])
                        chosen.append(hashes[order[: len(hashes) * (100 - percent) // 100 + 1]])
                    row = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
                    keys = np.concatenate(chosen).view(np.int64) if chosen else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), part.column("id").take(pa.array(row))], ["key", "id"])

        return texts.mapInArrow(first_elements, "key long, id long")

    return narrow


def parities(hashes: np.ndarray) -> bytes:
    """Bits, at least two for an element and a power of two, each the parity of the number of elements that fall there."""
    bits = 64
    while bits < 2 * len(hashes):
        bits *= 2
    counts = np.bincount((hashes >> np.uint64(16) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1 == 1, bitorder="little").tobytes()


def folded(rows: Spans, width: int) -> np.ndarray:
    """Parities as if taken in ``width`` words at first."""
    out = np.empty((len(rows.first), width), np.uint64)
    for size in np.unique(rows.size).tolist():
        some = np.flatnonzero(rows.size == size)
        words = rows.words[rows.first[some][:, None] + np.arange(size)]
        out[some] = np.bitwise_xor.reduce(words.reshape(len(some), size // width, width), axis=1)
    return out


def few_unlike(percent: int):
    """Which sets may be alike. Bits in which their parities differ are at most the elements that only one of them has."""

    def apart_of(a: Spans, b: Spans) -> np.ndarray:
        width = np.minimum(a.size, b.size)
        apart = np.zeros(len(width), np.int64)
        for w in np.unique(width).tolist():
            wide = np.flatnonzero(width == w)
            step = max(1, PARITY_WORDS // w)
            for some in (wide[k : k + step] for k in range(0, len(wide), step)):
                apart[some] = np.bitwise_count(folded(a.of(some), w) ^ folded(b.of(some), w)).sum(1)
        return apart

    def settle(a: Spans, b: Spans) -> np.ndarray:
        # The first word is the size. Of n + m elements, alike sets have at most a share (1 - t) / (1 + t) in one only.
        total = (a.words[a.first] + b.words[b.first]).astype(np.int64)
        return apart_of(a.after(1), b.after(1)) * (100 + percent) <= (100 - percent) * total

    return settle


def near_groups(docs: DataFrame, scratch: Scratch, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, component_id, root (one per group; NULL without a set).

    Documents are linked when 100 * |A ∩ B| >= percent * |A ∪ B|. Equal sets are
    folded before anything is compared. A pair at the threshold shares none of the
    32 bands with probability 1e-10 at 85 percent and 5e-8 at 80; bits of registers,
    and estimates from them, each drop it with probability 3e-7.
    """
    threshold = percent / 100
    sketched = scratch.stage(sketches(docs), "sketches")
    sets = sketched.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("sketch", "coarse", "parity", "keys")]
    )
    sets = scratch.stage(sets.withColumn("id", F.monotonically_increasing_id()), "sets")

    estimate = likely(threshold)

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("sketch").alias(f"{side}_sketch")), side)
        pairs = pairs.select("a", "b", "a_sketch", "b_sketch").mapInArrow(rows_alike(estimate), "a long, b long")
        pairs = scratch.stage(pairs, f"{name}-likely")
        nodes = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        wanted = sets.join(nodes, "id", "left_semi").select("id", "digest", F.col("least").alias("doc_id"))
        wanted = scratch.stage(wanted, f"{name}-wanted")
        texts = scratch.stage(texts_of(docs, wanted), f"{name}-texts")
        for side in "ab":
            pairs = pairs.join(texts.select(F.col("id").alias(side), F.col("text").alias(f"{side}_text")), side)
        edges = scratch.stage(confirmed(pairs, percent), f"{name}-edges")
        for done in ("likely", "wanted", "texts"):
            scratch.drop(f"{name}-{done}")
        return edges

    narrow = rarest_elements(docs, sets, percent, scratch)
    keys = sets.select(F.explode(F.array_distinct("keys")).alias("key"), "id")
    coarse = sets.select("id", F.col("coarse").alias("sketch"), F.col("parity").alias("detail"))
    groups = linked_components(keys, coarse, few_bits_apart(threshold), verify, scratch, "near", narrow, few_unlike(percent))
    rooted = sets.select("id", "digest", "least").join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        "digest", "least", F.coalesce("root", "id").alias("root")
    )
    rooted = scratch.stage(rooted, "rooted")
    for done in ("sets", "open-wanted", "open-texts"):
        scratch.drop(done)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("digest", "component_id", "root")
    # Documents without a set have no row in ``named``.
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return sketched.select("doc_id", "text_key", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "text_key", "n_shingles", "root", alone.otherwise(F.col("component_id")).alias("component_id")
    )


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text): one text of each wanted set. A doc_id may stand on differing rows, so sets are compared again.

    Bits of the wanted ids, a fixed number, go to the tasks that read the texts, so that few other texts leave them.
    """
    shared = flags_of(wanted.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id")))

    def maybe(batches):
        for batch in batches:
            yield batch.filter(pa.array(flagged(shared.value, batch.column("doc_id").fill_null(0).to_numpy())))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                raw, at = string_parts(part.column("text"))
                wanted = part.column("digest").to_pylist()
                keep = [
                    hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() == wanted[i]
                    for i, hashes in enumerate(word_sets(raw, at))
                ]
                yield part.select(["id", "text"]).filter(pa.array(keep, pa.bool_()))

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(maybe, "doc_id long, text string")
    met = rows.join(wanted, rows.doc_id.eqNullSafe(wanted.doc_id)).select("id", "digest", "text")
    return met.mapInArrow(run, "id long, text string").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "a_text"):
                keep = []
                both = [word_sets(*string_parts(part.column(c))) for c in ("a_text", "b_text")]
                for left, right in zip(*both):
                    shared = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(100 * shared >= percent * (len(left) + len(right) - shared))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, scratch: Scratch, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return near_groups(docs, scratch, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def one_of_each(docs: DataFrame, scratch: Scratch, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each group, of its smallest id, all columns as they were; rows without a set stay.

    Rows are told apart by id and text, as an id may stand on differing texts.
    """
    grouped = near_groups(docs, scratch, percent).filter("root IS NOT NULL")
    places = scratch.stage(grouped.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n")), "places")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    stays = places.groupBy("root").agg(F.min(order).alias("stays"))
    kept = order.eqNullSafe(F.col("stays"))
    # Only rows that go, or stand several times, have a mark.
    marks = places.join(stays, "root").filter(~kept | (F.col("n") > 1)).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), kept.alias("_kept")
    )
    met = docs.join(marks, docs["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key")), "left")
    once = met.filter("_kept").dropDuplicates(["_id", "_key"])
    return met.filter("_kept IS NULL").union(once).select(*docs.columns)
