"""Approximate nearest neighbours by an inverted multi-index.

Vectors are scaled to length one and cut into halves. Each half is quantised by its
own centroids, so K centroids a half make K * K cells. A query walks the cells in
order of the summed distances of its halves, with a heap, until the cells hold as
many vectors as it is to see; these are compared in full.

Centroids are fitted on a bounded sample. How many vectors a query sees is measured:
for a bounded sample of queries all true neighbours are found by brute force, and
the number is taken at which the walk has met nearly all of them. Every vector is
indexed. Equal vectors are folded into one entry that keeps its smallest ids, one
more than the wanted neighbours, which is all that a result can hold of them.

Defined results: vectors that are NULL, of zero length, of another dimension than
most, or with a NULL or non-finite component take no part; with fewer candidates
than asked for, all are returned; ties (cosines that agree to 12 decimals) go to the
smaller id; a repeated id is a candidate once, and never one of its own.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.samples import bounded
from larder.sources.storage import Scratch

NEIGHBOURS = 5
# Bounds of the samples: vectors to fit centroids on, and queries to measure with.
FIT_ROWS = 20_000
MEASURED_QUERIES = 64
# Vectors to a cell, on average, and the most centroids for a half.
CELL_ROWS = 32
MOST_CENTROIDS = 1_024
ROUNDS = 12
# Rough scores are off by less than this; exact ones that agree to so many decimals are ties.
ROUGH = 1e-9
TIE_DECIMALS = 12
# The share of true neighbours that the walk has to meet for the measured queries.
AIM = 0.97
# Rows of a cell that are compared in one task, and queries likewise.
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 512


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and the vector as doubles, for the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.coalesce(sound, F.lit(False)))
    rows = rows.filter(F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (sizes.n if sizes else 0))


def folded(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with their ``keep`` smallest ids. Copies are thinned in every task before they meet."""
    rows = rows.dropDuplicates(["vec_id", "v"])
    thinned = rows.groupBy("v", F.spark_partition_id().alias("part"), F.shiftright("vec_id", 12).alias("block"))
    some = thinned.agg(F.slice(F.array_sort(F.collect_set("vec_id")), 1, keep).alias("ids"))
    return some.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"))


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)[None, :]


def fit_centroids(x: np.ndarray, count: int) -> np.ndarray:
    """Lloyd's rounds from evenly picked rows."""
    centroids = x[np.linspace(0, len(x) - 1, count).astype(int)].copy()
    for _ in range(ROUNDS):
        nearest = squared_distances(x, centroids).argmin(1)
        sizes = np.bincount(nearest, minlength=count)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
    return centroids


class MultiIndex:
    """Centroids of both halves, and how many vectors each cell holds."""

    def __init__(self, halves: tuple[np.ndarray, np.ndarray]):
        self.halves = halves
        self.cut = halves[0].shape[1]
        self.count = len(halves[0])
        # Of every cell, at most ``MOST_CENTROIDS`` squared: four megabytes.
        self.sizes = np.zeros(self.count**2, np.int32)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared_distances(x[:, : self.cut], self.halves[0]), squared_distances(x[:, self.cut :], self.halves[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = self.distances(x)
        return first.argmin(1) * self.count + second.argmin(1)

    def walk(self, first: np.ndarray, second: np.ndarray, enough: int):
        """Cells in order of summed distance, until they hold ``enough`` vectors."""
        by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        heap, seen = [(first[by_first[0]] + second[by_second[0]], 0, 0)], 0
        while heap and seen < enough:
            _, i, j = heapq.heappop(heap)
            cell = int(by_first[i]) * self.count + int(by_second[j])
            size = int(self.sizes[cell])
            if size:
                seen += size
                yield cell, seen
            # Each pair is reached once: along its row, or from the row before at its start.
            if j + 1 < self.count:
                heapq.heappush(heap, (first[by_first[i]] + second[by_second[j + 1]], i, j + 1))
            if j == 0 and i + 1 < self.count:
                heapq.heappush(heap, (first[by_first[i + 1]] + second[by_second[0]], i + 1, 0))


def matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(len(column), -1)


def near_one(x: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two, which changes no cosine: squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1])


def cosines(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosine of the original vectors in double precision, the same for a pair wherever it is computed."""
    query, others = near_one(query), near_one(others)
    length = np.sqrt((query * query).sum()) * np.sqrt((others * others).sum(1))
    return (others * query).sum(1) / length


def build(entries: DataFrame, rows: int, scratch: Scratch) -> tuple[MultiIndex, DataFrame]:
    """The index, and every entry with its cell."""
    sample = bounded(entries.select("v"), F.xxhash64("v"), FIT_ROWS, rows).orderBy("v").toArrow()
    x = unit(matrix(sample.column("v")))
    count = max(1, min(MOST_CENTROIDS, len(x) // 4, math.ceil(math.sqrt(rows / CELL_ROWS))))
    cut = max(1, x.shape[1] // 2)
    index = MultiIndex((fit_centroids(x[:, :cut], count), fit_centroids(x[:, cut:], count)))

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                cells = index.cells(unit(matrix(batch.column("v"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])

    placed = scratch.stage(entries.mapInArrow(place, "v array<double>, ids array<long>, cell long"), "placed")
    filled = placed.groupBy("cell").count().toArrow()
    index.sizes[filled.column("cell").to_numpy()] = np.minimum(filled.column("count").to_numpy(), 2**31 - 1)
    return index, placed


def top(query: np.ndarray, others: np.ndarray, rough: np.ndarray, least_ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact cosines of the ``keep`` nearest, nearest first.

    All that the rough scores cannot tell apart at the edge are scored exactly. Cosines
    that agree to ``TIE_DECIMALS`` are ties, as of vectors that differ in length only.
    """
    some = np.arange(len(rough))
    if len(rough) > keep:
        some = np.flatnonzero(rough >= np.partition(rough, len(rough) - keep)[len(rough) - keep] - ROUGH)
    exact = cosines(query, others[some])
    first = np.lexsort([least_ids[some], -np.round(exact, TIE_DECIMALS)])[:keep]
    return some[first], exact[first]


def enough_to_see(index: MultiIndex, placed: DataFrame, queries: DataFrame, keep: int, aim: float) -> int:
    """How many vectors a walk has to see to meet ``aim`` of the true neighbours of a bounded sample of queries."""
    some = bounded(queries.select("v"), F.xxhash64("v"), MEASURED_QUERIES, queries.count()).orderBy("v").toArrow()
    if not some.num_rows:
        return 1
    asked = matrix(some.column("v"))
    asked_units = unit(asked)

    def nearest(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = asked_units @ unit(matrix(batch.column("v"))).T
            cells = batch.column("cell").to_numpy()
            for q in range(len(asked)):
                best = np.argsort(-scores[q])[: keep + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), q)), pa.array(scores[q, best]), pa.array(cells[best])], ["q", "score", "cell"]
                )

    # In each task, and then of all tasks: the nearest few of each measured query.
    found = placed.mapInArrow(nearest, "q long, score double, cell long")
    ranked = found.groupBy("q").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("score", "cell")), asc=False), 1, keep + 1).alias("best")
    )
    first, second = index.distances(asked_units)
    needed = []
    for r in ranked.collect():
        met = dict(index.walk(first[r.q], second[r.q], int(index.sizes.sum(dtype=np.int64)) + 1))
        needed += [met[b.cell] for b in r.best]
    return int(np.quantile(needed, aim, method="higher"))


def neighbours(vectors: DataFrame, every: int, scratch: Scratch, keep: int = NEIGHBOURS, aim: float = AIM) -> DataFrame:
    """query_id, rank, vec_id, score of the ``keep`` nearest found for each id divisible by ``every``."""
    rows = scratch.stage(usable(vectors), "usable")
    # One more than asked for: a query's own id is left out at the end.
    entries = scratch.stage(folded(rows, keep + 1), "entries")
    asked = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "v").dropDuplicates()
    queries = scratch.stage(asked.select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
    total = entries.count()
    empty = "query_id long, rank int, vec_id long, score double"
    if not total:
        return vectors.sparkSession.createDataFrame([], empty)
    index, placed = build(entries, total, scratch)
    enough = max(keep + 1, enough_to_see(index, placed, queries, keep, aim))

    def routes(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            first, second = index.distances(unit(matrix(batch.column("v"))))
            for k in range(batch.num_rows):
                cells = np.sort([cell for cell, _ in index.walk(first[k], second[k], enough)])
                group = cells % groups
                order = np.argsort(group, kind="stable")
                names, starts = np.unique(group[order], return_index=True)
                one = batch.slice(k, 1).take(pa.array(np.zeros(len(names), np.int64)))
                lists = pa.ListArray.from_arrays(pa.array([*starts, len(cells)], pa.int32()), pa.array(cells[order]))
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array(names, pa.int64()), lists], ["q", "v", "group", "cells"])

    def compare(table):
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        x, cells = matrix(table.column("v")), table.column("cells").to_pylist()
        entry, asking = np.flatnonzero(~asks), np.flatnonzero(asks)
        out_q, out_id, out_score = [], [], []
        if len(entry) and len(asking):
            q, ids = table.column("q").to_numpy(zero_copy_only=False), table.column("ids").to_pylist()
            least = np.array([ids[i][0] for i in entry], np.int64)
            known, place = np.unique([cells[i][0] for i in entry], return_inverse=True)
            rough = unit(x[asking]) @ unit(x[entry]).T
            for row, k in zip(rough, asking):
                visited = np.isin(known, cells[k])[place]
                some = np.flatnonzero(visited)
                for i, score in zip(*top(x[k], x[entry[some]], row[some], least[some], keep + 1)):
                    out_q.append(q[k])
                    out_id.append(ids[entry[some[i]]])
                    out_score.append(score)
        return pa.table(
            {
                "q": pa.array(np.array(out_q, np.int64)),
                "ids": pa.array(out_id, pa.list_(pa.int64())),
                "score": pa.array(out_score, pa.float64()),
            }
        )

    # Cells are gathered into groups of about BLOCK_ROWS vectors. A group beyond that is dealt into
    # slots, and its queries into sets; each set meets each slot.
    groups = 1 + total // BLOCK_ROWS
    group = F.pmod("cell", F.lit(groups))
    routed = queries.select("q", "v").mapInArrow(routes, "q long, v array<double>, group long, cells array<long>")
    routed = scratch.stage(routed, "routed")
    slots = placed.groupBy(group.alias("group")).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("slots"))
    sets = routed.groupBy("group").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("sets"))
    parts = slots.join(sets, "group")
    slot, every_slot = F.pmod(F.xxhash64("v"), "slots").cast("int"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1))
    own_set, every_set = F.pmod(F.xxhash64("q"), "sets").cast("int"), F.explode(F.sequence(F.lit(0), F.col("sets") - 1))
    asking = routed.join(parts, "group").select(
        "group", every_slot.alias("slot"), own_set.alias("set"), "q", "v", "cells",
        F.array().cast("array<long>").alias("ids"), F.lit(True).alias("asks"),
    )
    holding = placed.withColumn("group", group).join(parts, "group").select(
        "group", slot.alias("slot"), every_set.alias("set"), F.lit(0).cast("long").alias("q"), "v",
        F.array("cell").alias("cells"), "ids", F.lit(False).alias("asks"),
    )
    met = asking.unionByName(holding).groupBy("group", "slot", "set")
    found = met.applyInArrow(compare, "q long, ids array<long>, score double")
    far = (-F.round("score", TIE_DECIMALS)).alias("far")
    best = found.groupBy("q").agg(F.collect_list(F.struct(far, "score", "ids")).alias("best"))
    ordered = F.flatten(
        F.transform(
            "best",
            lambda b: F.transform(b["ids"], lambda i: F.struct(b["far"].alias("far"), i.alias("vec_id"), b["score"].alias("score"))),
        )
    )
    best = best.select("q", F.slice(F.array_sort(ordered), 1, keep + 1).alias("best"))
    answers = asked.join(queries, "v").join(best, "q")
    others = F.filter("best", lambda b: b["vec_id"] != F.col("query_id"))
    answers = answers.select(F.col("vec_id").alias("query_id"), "best").select("query_id", F.slice(others, 1, keep).alias("best"))
    return answers.select("query_id", F.posexplode("best").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score")
    )
