"""Whitening of embeddings from exact, bit-sliced second moments.

Entries become integers, each dimension is shifted to start at 0, and its bit planes
are packed across rows into 64-bit words. The cross-product of two dimensions is then
a sum of AND-popcounts of their planes, weighted by powers of two: counts only, so
tasks add up exactly in any order. They are centred as integers (n * sum(xy) -
sum(x) * sum(y)) before anything becomes a float, and the covariance is decomposed
once on the driver, whose share is dimensions x dimensions whatever the number of rows.

Defined results: vectors that are NULL, empty, or hold a NULL or non-finite entry take
no part; where lengths differ, the length that most vectors have counts (of equally
frequent ones the larger) and the others take no part. Repeated rows and NULL ids
count and are returned like any other row. Entries beyond 2**55, either
way, are taken as 2**55.
Directions without variance have no whitened value and are not numbered, so a single
vector, or none, gives no rows. A deviation that no long can hold is NULL. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

STEPS_A_UNIT = 64
OFFSET = 1_000_000
LARGEST = 2.0**61
COMPONENTS = 32
# Rows whose planes are packed at once: 64 words a plane.
PACKED_ROWS = 4096
# Sums of whitened values travel as whole numbers of this size, so that their order does not matter.
FIXED_POINT = 2.0**20


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector has entries, all of them finite."""
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0) & finite)


def integers(column: pa.Array, dimensions: int) -> np.ndarray:
    """floor(64 * c) + 1000000 of a batch, a row per vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        steps = np.clip(np.floor(entries * STEPS_A_UNIT), -LARGEST, LARGEST)
    return steps.astype(np.int64).reshape(-1, dimensions) + OFFSET


def length_of_most(vectors: DataFrame, column: str) -> int:
    """The length that most vectors have; 0 if there is none."""
    sizes = vectors.groupBy(F.size(column).alias("size")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return first["size"] if first else 0


@dataclass
class Moments:
    """Number of rows, and per dimension the smallest value, the largest and the sum."""

    n: int
    low: list[int]
    high: list[int]
    total: list[int]

    @property
    def shifted(self) -> list[int]:
        """Sums of the values less their smallest."""
        return [s - self.n * a for s, a in zip(self.total, self.low)]

    @property
    def planes(self) -> list[tuple[int, int]]:
        """(dimension, bit) of every plane, dimension after dimension."""
        return [(d, p) for d, (a, b) in enumerate(zip(self.low, self.high)) for p in range((b - a).bit_length())]


def moments(vectors: DataFrame, column: str, dimensions: int) -> Moments:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, total = 0, None, None, [0] * dimensions
        for batch in batches:
            x = integers(batch.column(0), dimensions)
            if not len(x):
                continue
            n += len(x)
            least, most = x.min(0), x.max(0)
            low = least if low is None else np.minimum(low, least)
            high = most if high is None else np.maximum(high, most)
            # What lies above the batch's smallest values is added up in two halves, so no sum overflows.
            above = (x - least).astype(np.uint64)
            sums = ((above >> np.uint64(32)).sum(0), (above & np.uint64(0xFFFFFFFF)).sum(0))
            for d in range(dimensions):
                total[d] += (int(sums[0][d]) << 32) + int(sums[1][d]) + len(x) * int(least[d])
        if n:
            yield pa.RecordBatch.from_pydict(
                {
                    "d": pa.array(range(dimensions), pa.int32()),
                    "n": pa.array([n] * dimensions, pa.int64()),
                    "low": pa.array(low, pa.int64()),
                    "high": pa.array(high, pa.int64()),
                    "upper": pa.array([t >> 32 for t in total], pa.int64()),
                    "lower": pa.array([t & 0xFFFFFFFF for t in total], pa.int64()),
                }
            )

    parts = vectors.select(column).mapInArrow(run, "d int, n long, low long, high long, upper long, lower long")
    rows = parts.groupBy("d").agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("upper").alias("upper"),
        F.sum("lower").alias("lower"),
    )
    by = sorted(rows.collect())  # one row per dimension
    return Moments(
        by[0]["n"],
        [r["low"] for r in by],
        [r["high"] for r in by],
        [(r["upper"] << 32) + r["lower"] for r in by],
    )


def packed_planes(above: np.ndarray, planes: list[tuple[int, int]]) -> np.ndarray:
    """Bit planes of up to ``PACKED_ROWS`` rows: a line of 64-bit words per plane."""
    words = -(-len(above) // 64)
    bits = np.zeros((len(planes), words * 64), np.uint8)
    for k, (d, p) in enumerate(planes):
        bits[k, : len(above)] = (above[:, d] >> np.uint64(p)) & np.uint64(1)
    return np.packbits(bits, axis=1).view(np.uint64)


class PlaneCounts:
    """Rows that have both of two bits, added up by dimension, other dimension and weight."""

    def __init__(self, planes: list[tuple[int, int]], dimensions: int):
        self.dimension = np.array([d for d, _ in planes], int)
        self.bit = np.array([p for _, p in planes], int)
        weights = 2 * int(self.bit.max(initial=0)) + 1
        self.counts = np.zeros((dimensions, weights, dimensions), np.int64)

    def add(self, words: np.ndarray) -> None:
        for k in range(len(words)):
            both = np.bitwise_count(words[k] & words[k:]).sum(1, dtype=np.int64)
            # Two bits of one dimension meet twice in its square, a bit meets itself once.
            both[1:][self.dimension[k + 1 :] == self.dimension[k]] *= 2
            self.counts[self.dimension[k], self.bit[k] + self.bit[k:], self.dimension[k:]] += both


def cross_products(vectors: DataFrame, column: str, seen: Moments) -> list[list[int]]:
    """Exact sums of products of the shifted dimensions, upper triangle."""
    dimensions = len(seen.low)
    low, planes = np.array(seen.low, np.int64), seen.planes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = PlaneCounts(planes, dimensions)
        for batch in batches:
            above = (integers(batch.column(0), dimensions) - low).astype(np.uint64)
            for start in range(0, len(above), PACKED_ROWS):
                sums.add(packed_planes(above[start : start + PACKED_ROWS], planes))
        d, weight = np.nonzero(sums.counts.any(2))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(d, pa.int32()),
                pa.array(weight, pa.int32()),
                pa.array(list(sums.counts[d, weight]), pa.list_(pa.int64())),
            ],
            ["d", "weight", "counts"],
        )

    parts = vectors.select(column).mapInArrow(run, "d int, weight int, counts array<long>")
    each = F.array(*[F.sum(F.col("counts")[e]) for e in range(dimensions)])
    products = [[0] * dimensions for _ in range(dimensions)]
    # A row per dimension and weight, so at most 127 a dimension.
    for row in parts.groupBy("d", "weight").agg(each.alias("counts")).collect():
        for e, count in enumerate(row["counts"]):
            products[row["d"]][e] += count << row["weight"]
    return products


@dataclass
class Whitening:
    """What turns a vector into its components."""

    n: int
    low: np.ndarray
    shifted: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """x - S/n as doubles, and the exact deviations."""
        above = x - self.low
        dimensions = x.shape[1]
        reach = max(self.n * int(above.max(initial=0)), max(self.shifted))
        if dimensions * reach**2 < 2**63:
            apart = self.n * above - np.array(self.shifted, np.int64)
            return apart / self.n, (apart * apart).sum(1).tolist()
        exact = self.n * above.astype(object) - np.array(self.shifted, object)
        deviations = [int(v) for v in (exact * exact).sum(1)]
        return (exact / self.n).astype(float), [v if v < 2**63 else None for v in deviations]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.vectors / np.sqrt(self.values)


def decomposed(seen: Moments, products: list[list[int]], components: int) -> Whitening:
    """The covariance, centred in whole numbers, and its largest components."""
    dimensions, n, sums = len(seen.low), seen.n, seen.shifted
    covariance = np.zeros((dimensions, dimensions))
    trace = 0
    for d in range(dimensions):
        trace += n * products[d][d] - sums[d] ** 2
        for e in range(d, dimensions):
            covariance[d, e] = covariance[e, d] = (n * products[d][e] - sums[d] * sums[e]) / n**2
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > dimensions * np.finfo(float).eps * max(values.max(), 0.0)]
    values = values[order]
    share = values / (trace / n**2) if trace else values
    return Whitening(n, np.array(seen.low, np.int64), sums, vectors[:, order], values, share)


def identity_error(vectors: DataFrame, column: str, by: Whitening) -> float:
    """The largest entry of the whitened values' covariance, less the identity."""
    dimensions, size = len(by.low), len(by.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            y = by.whitened(by.centred(integers(batch.column(0), dimensions))[0])
            sums += y.sum(0)
            products += y.T @ y
        parts = np.column_stack([sums, products])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(size), pa.int32()),
                pa.array(list(np.rint(parts * FIXED_POINT).astype(np.int64)), pa.list_(pa.int64())),
            ],
            ["k", "parts"],
        )

    parts = vectors.select(column).mapInArrow(run, "k int, parts array<long>")
    each = F.array(*[F.sum(F.col("parts")[e]) for e in range(size + 1)])
    rows = np.array([r["parts"] for r in sorted(parts.groupBy("k").agg(each.alias("parts")).collect())], float)
    means, products = rows[:, 0] / FIXED_POINT / by.n, rows[:, 1:] / FIXED_POINT / by.n
    return float(np.abs(products - np.outer(means, means) - np.eye(size)).max())


def fitted(vectors: DataFrame, column: str, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors of the prevailing length; None if none vary."""
    dimensions = length_of_most(vectors, column)
    if not dimensions:
        return None
    same = vectors.filter(F.size(column) == dimensions)
    seen = moments(same, column, dimensions)
    by = decomposed(seen, cross_products(same, column, seen), components)
    return by if len(by.values) else None


def whitened(
    embeddings: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row per vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    vectors = usable(embeddings.select(key, column), column)
    schema = StructType().add(key, embeddings.schema[key].dataType).add("component", IntegerType())
    schema = schema.add("n", LongType()).add("deviation", LongType())
    for name in ("whitened", "explained", "identity_error"):
        schema = schema.add(name, DoubleType())
    by = fitted(vectors, column, components)
    if by is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    dimensions, size = len(by.low), len(by.values)
    same = vectors.filter(F.size(column) == dimensions)
    error = identity_error(same, column, by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred, deviations = by.centred(integers(batch.column(1), dimensions))
            count = len(centred)
            rows = np.repeat(np.arange(count), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, size + 1), count), pa.int32()),
                    pa.array(np.full(count * size, by.n), pa.int64()),
                    pa.array(deviations, pa.int64()).take(pa.array(rows)),
                    pa.array(by.whitened(centred).ravel()),
                    pa.array(np.tile(by.explained, count)),
                    pa.array(np.full(count * size, error)),
                ],
                schema.names,
            )

    return same.mapInArrow(run, schema)
