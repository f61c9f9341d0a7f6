"""Connected components, and links between similar rows, without all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.text import inside, mixed, string_parts
from larder.sources.storage import Scratch

# Rows of a key that are compared in one task: two blocks of this size.
BLOCK_ROWS = 2_000
# Rounds that suffice for any group: each at least halves its height.
ROUNDS = 60
# Partners that a row tries in the first round, per key and block.
BEST = 3
# Pairs of rows whose sketches are compared at once.
PAIRS_AT_ONCE = 1 << 17
# Bits by which wanted rows are found while a table is read: 2 MB, whatever their number.
FLAG_BITS = 1 << 24


class Spans:
    """Numbers of 64 bits, some for each row; ``of`` picks rows, ``after`` skips their first numbers."""

    def __init__(self, raw: np.ndarray, at: np.ndarray):
        self.words, self.first, self.size = raw.view(np.uint64), at[:-1] // 8, np.diff(at) // 8

    def of(self, rows: np.ndarray) -> Spans:
        out = Spans.__new__(Spans)
        out.words, out.first, out.size = self.words, self.first[rows], self.size[rows]
        return out

    def after(self, count: int) -> Spans:
        out = self.of(slice(None))
        out.first, out.size = out.first + count, out.size - count
        return out


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reached.

    Each round first joins every node's larger neighbours to its smallest one,
    then the smaller ones, until all edges end in a root. No step adds edges, a
    node's neighbours are only ever reduced to their minimum, and every round is
    a written table. Rounds grow with the logarithm of a group's diameter.
    """
    edges = edges.select("a", "b").filter("a <> b")
    state = None
    for step in range(ROUNDS):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = larger.filter("a <> b").distinct()
        below = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(below, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        smaller = smaller.union(below.select("a", F.col("m").alias("b")))
        edges = scratch.stage(smaller.filter("a <> b").distinct(), f"{name}-{step}")
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    else:
        raise RuntimeError(f"{name}: groups are not settled after {ROUNDS} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())


def linked_components(
    keys: DataFrame,
    sketches: DataFrame,
    score: Callable[[np.ndarray, np.ndarray], np.ndarray],
    verify: Callable[[DataFrame, str], DataFrame],
    scratch: Scratch,
    name: str,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
    settle: Callable[[Spans, Spans], np.ndarray] | None = None,
    details: Callable[[DataFrame], DataFrame] | None = None,
    confirm: Callable[[pa.Array, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
) -> DataFrame:
    """Components of the rows that share a key and are truly alike: (node, root), for joined rows only.

    ``keys`` has distinct rows (key, id), both longs, and ``sketches`` one row per ``id``
    with a binary ``sketch`` of fixed width. ``score(a, b)`` compares sketches, as rows of
    bytes; it is minus infinity only for pairs that are not alike. ``verify(pairs,
    name)`` keeps the pairs (a, b) that hold on full data. ``narrow(ids)`` may give
    other, more selective keys for the rows left over, (key, id) such that alike rows of
    ``ids`` still share a key. ``settle`` then compares the rows' ``detail``, a further
    binary column of ``sketches`` of any width, and says which pairs may be alike. Both
    go with every key of a row left over, so they should be small, and tell apart what
    a family of copies holds in pairs that are nearly alike: every pair left is a row.
    ``details(ids)`` may give the ``detail`` of the rows left over, (id, detail), for some
    or all of them. With it goes ``confirm(detail, left, right)``: of pairs of rows, the
    places of those that may hold, and whether they surely do, which ``verify`` then need
    not see. So pairs that do not hold are never rows, however many there are.

    First every row is compared with the smallest row under each of its keys, so a
    group of n rows costs n pairs. Rows that this already joins need no other
    proof. What is left are keys whose rows lie in several components: there, rows
    outside the smallest row's component are compared with the rows of all other
    components, in blocks of bounded size. One round tries each row's best partners
    only, which joins nearly all that belong together; the last takes every pair
    still open. So each pair under a shared key is compared, or its rows are known
    to be joined, and no link between components is lost.
    """
    first = keys.groupBy("key").agg(F.min("id").alias("f_id"), F.count("*").alias("n")).filter("n > 1")
    under = scratch.stage(keys.select("key", "id").join(first.select("key", "f_id"), "key"), f"{name}-keys")
    small = sketches.select("id", "sketch")
    star = under.filter("id <> f_id").select(F.col("f_id").alias("a"), F.col("id").alias("b")).distinct()
    for side in "ab":
        star = star.join(small.select(F.col("id").alias(side), F.col("sketch").alias(f"{side}_sketch")), side)
    star = star.select("a", "b", "a_sketch", "b_sketch").mapInArrow(rows_alike(score), "a long, b long")
    edges = verify(scratch.stage(star, f"{name}-star-pairs"), f"{name}-star")
    reached = scratch.stage(components(edges, scratch, f"{name}-c0"), f"{name}-roots0")
    # The smallest row of a key was compared with all others above.
    open_rows = scratch.stage(_several_components(under.filter("id <> f_id").select("key", "id"), reached), f"{name}-open")
    scratch.drop(f"{name}-star-pairs")
    if narrow:
        open_rows = scratch.stage(narrow(open_rows.select("id").distinct()), f"{name}-narrow")
    if details:
        sketches = sketches.select("id", "sketch").join(details(open_rows.select("id").distinct()), "id", "left")
    elif not settle:
        sketches = sketches.select("id", "sketch", F.lit(None).cast("binary").alias("detail"))
    scratch.drop(f"{name}-keys")
    for step, best in enumerate((BEST, None), 1):
        marked = open_rows.select("key", "id")
        marked = scratch.stage(_several_components(marked, reached), f"{name}-open{step}")
        pairs = scratch.stage(_pairs(marked, sketches, score, settle, best, confirm), f"{name}-pairs{step}")
        found = verify(pairs.filter("NOT sure").select("a", "b"), f"{name}-round{step}")
        if confirm:
            found = scratch.stage(pairs.filter("sure").select("a", "b").union(found), f"{name}-found{step}")
        none = found.isEmpty()
        for done in (f"{name}-open{step}", f"{name}-pairs{step}"):
            scratch.drop(done)
        if none:
            continue
        reached = scratch.stage(_joined(reached, found, scratch, f"{name}-c{step}"), f"{name}-roots{step}")
    return reached


def _joined(reached: DataFrame, found: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``reached`` after the edges ``found``: only the roots that these join go through the rounds."""
    ends = found
    for side in "ab":
        ends = ends.join(reached.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
    roots = ends.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")).distinct()
    moved = scratch.stage(components(scratch.stage(roots, f"{name}-open"), scratch, name), f"{name}-moved")
    moved = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = reached.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    new = moved.join(reached.select(F.col("node").alias("root")), "root", "left_anti").select("root", "to")
    return old.union(new)


def _several_components(rows: DataFrame, reached: DataFrame) -> DataFrame:
    """The rows (key, id) of keys that lie in several components: key, id, root, f_root of the key's smallest root, n."""
    marked = rows.join(reached.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    keys = marked.groupBy("key").agg(F.min("root").alias("f_root"), F.max("root").alias("l_root"), F.count("*").alias("n"))
    return marked.join(keys.filter("f_root <> l_root").select("key", "f_root", "n"), "key")


def _pairs(marked: DataFrame, sketches: DataFrame, score, settle, best: int | None, confirm=None) -> DataFrame:
    """Pairs (a, b, sure) of different components under a key that may be alike, or surely are; or of each row's ``best`` in a block."""
    sized = marked.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).join(sketches, "id")
    own = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["key", "id", "root", "sketch", "detail"]
    asks, split = F.col("root") != F.col("f_root"), F.col("blocks") > 1
    none = F.lit(0).alias("i"), F.lit(0).alias("j")
    # Under a key of one block a row asks and is asked; else it goes to every block of the other side.
    whole = sized.filter(~split).select(*columns, *none, asks.alias("asks"), F.lit(True).alias("asked"))
    asking = sized.filter(split & asks).select(
        *columns, own.alias("i"), every.alias("j"), F.lit(True).alias("asks"), F.lit(False).alias("asked")
    )
    asked = sized.filter(split).select(
        *columns, every.alias("i"), own.alias("j"), F.lit(False).alias("asks"), F.lit(True).alias("asked")
    )
    group = ["key", "i", "j"]
    dealt = whole.union(asking).union(asked).repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_block_pairs(score, settle, best, confirm), "a long, b long, sure boolean").distinct()


def sketch_rows(column) -> np.ndarray:
    raw, at = string_parts(column)
    return raw.reshape(len(at) - 1, -1)


def rows_alike(score):
    """Keeps the rows (a, b, a_sketch, b_sketch) that ``score`` does not tell apart."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                near = score(sketch_rows(batch.column("a_sketch")), sketch_rows(batch.column("b_sketch")))
                yield batch.select(["a", "b"]).filter(pa.array(near > -np.inf))

    return run


def _block_pairs(score, settle, best, confirm=None):
    """Pairs of the rows of one group (key, i, j), for rows that come group by group: most groups are small, so many are compared at once."""

    def pairs(rows):
        if not rows.num_rows:
            return
        group = np.column_stack([rows.column(c).to_numpy() for c in ("key", "i", "j")])
        opens = np.flatnonzero(np.append(True, (group[1:] != group[:-1]).any(1)))
        size = np.diff(np.append(opens, len(group)))
        of = np.repeat(np.arange(len(opens)), size)
        ids, roots = rows.column("id").to_numpy(), rows.column("root").to_numpy()
        asks, asked = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "asked"))
        sketch = sketch_rows(rows.column("sketch"))
        detail = Spans(*string_parts(rows.column("detail"))) if settle else None
        asks = np.flatnonzero(asks)
        part = np.cumsum(size[of[asks]]) // PAIRS_AT_ONCE
        for some in np.split(asks, np.flatnonzero(np.diff(part)) + 1):
            left = np.repeat(some, size[of[some]])
            right = inside(opens[of[some]], size[of[some]])
            open_pairs = np.flatnonzero(asked[right] & (roots[left] != roots[right]))
            left, right = left[open_pairs], right[open_pairs]
            if not len(left):
                continue
            near = score(sketch[left], sketch[right])
            keep = np.flatnonzero(near > -np.inf)
            if settle and len(keep):
                keep = keep[settle(detail.of(left[keep]), detail.of(right[keep]))]
            if best and len(keep):
                keep = keep[np.lexsort([-near[keep], left[keep]])]
                first = np.flatnonzero(np.append(True, np.diff(left[keep]) != 0))
                keep = keep[np.arange(len(keep)) - np.repeat(first, np.diff(np.append(first, len(keep)))) < best]
            sure = np.zeros(len(keep), bool)
            if confirm and len(keep):
                hold, sure = confirm(rows.column("detail"), left[keep], right[keep])
                keep = keep[hold]
            a, b = ids[left[keep]], ids[right[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(sure)], ["a", "b", "sure"])

    def run(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last group may go on in the next batch; groups are bounded, so what is held is.
            key = np.column_stack([batch.column(c).to_numpy() for c in ("key", "i", "j")])
            ends = int(np.flatnonzero((key != key[-1]).any(1)).max(initial=-1)) + 1
            if held:
                before = np.array([held[-1].column(c)[-1].as_py() for c in ("key", "i", "j")])
                if ends == 0 and (before == key[-1]).all():
                    held.append(batch)
                    continue
            held.append(batch.slice(0, ends))
            yield from pairs(pa.concat_batches(held))
            held = [batch.slice(ends)]
        if held:
            yield from pairs(pa.concat_batches(held))

    return run


def flag_places(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) % np.uint64(FLAG_BITS)).astype(np.int64)


def flags_of(keys: DataFrame):
    """Broadcast bits, a fixed number, of the longs in the one column of ``keys``."""
    column = keys.columns[0]

    def words(batches):
        for batch in batches:
            flags = np.zeros(FLAG_BITS, bool)
            flags[flag_places(batch.column(column).to_numpy())] = True
            packed = np.packbits(flags, bitorder="little").view(np.int64)
            some = np.flatnonzero(packed)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(packed[some])], ["word", "bits"])

    found = keys.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FLAG_BITS // 64, np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(bits.tobytes())


def flagged(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` may be wanted; all that are wanted are among them."""
    at = flag_places(keys)
    return (np.frombuffer(bits, np.uint8)[at >> 3] >> (at & 7) & 1).astype(bool)
