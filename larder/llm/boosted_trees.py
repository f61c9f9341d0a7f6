"""Quality by gradient-boosted trees over document statistics.

Trees are grown on histograms of at most 64 bins per statistic and stored as flat
arrays, so a batch of documents walks all trees at once in numpy. They are fitted
on a bounded sample of labelled rows (``samples.FIT_ROWS``); statistics and scores
are computed where the texts lie, without a shuffle.

Defined results: a NULL text counts as empty; an empty text has statistics of 0
and is scored like any other; without usable labels every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from larder.llm.samples import FIT_ROWS, id_remainder, labelled
from larder.llm.text import lower_ascii, shingle_hashes, slices, span_hashes, string_parts, word_bounds

ROUNDS = 80
DEPTH = 4
BINS = 64
RATE = 0.15
SHRINK = 1.0
LEAST_WEIGHT = 2.0
# Text whose statistics are taken at once: an executor's workers hold several numbers of 64 bits for each of its bytes.
PART_BYTES = 1 << 19

# Kinds of bytes that are counted.
KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t",
    "line": b"\n\r\x0b\x0c",
    "loud": b"!?",
    "stop": b".;:",
    "comma": b",",
    "quote": b"\"'`",
    "symbol": b"#$%&*+/<=>@\\^_|~",
    "bracket": b"()[]{}",
    "dash": b"-",
}


def kind_table() -> np.ndarray:
    table = np.full(256, len(KINDS), np.int64)
    for number, members in enumerate(KINDS.values()):
        table[np.frombuffer(members, np.uint8)] = number
    table[128:192] = len(KINDS) + 1
    table[192:] = len(KINDS) + 2
    return table


def statistics(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of numbers per text."""
    count = len(at) - 1
    kinds = len(KINDS) + 3
    length = np.diff(at)
    owner = np.repeat(np.arange(count) * kinds, length)
    shares = np.bincount(owner + kind_table()[raw], minlength=count * kinds).reshape(count, kinds)
    shares = shares / np.maximum(length, 1)[:, None]
    starts, ends, before = word_bounds(raw, at)
    words = np.diff(before)
    sizes = ends - starts
    hashes = span_hashes(lower_ascii(raw), starts, ends)
    capital = (raw[starts] >= 65) & (raw[starts] <= 90) if len(starts) else np.zeros(0, bool)
    loud = np.isin(raw[ends - 1], np.frombuffer(b"!?#$%&*", np.uint8)) if len(ends) else np.zeros(0, bool)
    breaks = np.flatnonzero(raw == 10)
    line_starts = np.unique(np.concatenate([at[:-1][length > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(raw)]
    line_ends = np.append(line_starts[1:], len(raw))
    lines_before = np.searchsorted(line_starts, at)
    line_hashes = span_hashes(raw, line_starts, line_ends)
    line_sizes = line_ends - line_starts
    rest = np.zeros((count, 11))
    for i in range(count):
        a, b = before[i], before[i + 1]
        if a == b:
            continue
        distinct, copies = np.unique(hashes[a:b], return_counts=True)
        c, d = lines_before[i], lines_before[i + 1]
        runs = max(1, b - a - 4)
        rest[i] = (
            sizes[a:b].mean(),
            sizes[a:b].std(),
            sizes[a:b].max(),
            len(distinct) / (b - a),
            copies.max() / (b - a),
            len(shingle_hashes(hashes[a:b], 5)) / runs,
            capital[a:b].mean(),
            loud[a:b].mean(),
            len(np.unique(line_hashes[c:d])) / max(1, d - c),
            line_sizes[c:d].mean() if d > c else 0,
            d - c,
        )
    return np.column_stack([shares, np.log1p(length), np.log1p(words), rest])


@dataclass
class Trees:
    """All nodes of all trees in one set of arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.start)))
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            goes_left = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.start + self.value[node].sum(1))))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost logistic loss; every level of a tree is grown from one histogram per statistic."""
    nodes: list[list[float]] = []
    roots = []
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        bins = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
        margin = np.full(len(y), start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
            roots.append(len(nodes))
            nodes.append([0, 0.0, 0, 0, 0.0])
            margin += grow(nodes, roots[-1], bins, edges, gradient, weight)
    table = np.array(nodes, float).reshape(-1, 5)
    return Trees(
        table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4],
        np.array(roots, int), start,
    )


def grow(nodes, root, bins, edges, gradient, weight) -> np.ndarray:
    """Grow one tree level by level from ``root``; returns each row's new part."""
    at = np.full(len(gradient), root)
    level = [root]
    for depth in range(DEPTH + 1):
        place = np.full(len(nodes), -1)
        place[level] = np.arange(len(level))
        mine = place[at]
        active = mine >= 0
        g = np.bincount(mine[active], gradient[active], len(level))
        h = np.bincount(mine[active], weight[active], len(level))
        for k, node in enumerate(level):
            nodes[node] = [0, 0.0, node, node, RATE * g[k] / (h[k] + SHRINK)]
        if depth == DEPTH:
            break
        best = np.zeros(len(level))
        choice = [None] * len(level)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            cell = mine[active] * BINS + bins[active, f]
            gs = np.bincount(cell, gradient[active], len(level) * BINS).reshape(-1, BINS).cumsum(1)[:, : len(e)]
            hs = np.bincount(cell, weight[active], len(level) * BINS).reshape(-1, BINS).cumsum(1)[:, : len(e)]
            gr, hr = g[:, None] - gs, h[:, None] - hs
            gain = gs**2 / (hs + SHRINK) + gr**2 / (hr + SHRINK) - (g**2 / (h + SHRINK))[:, None]
            gain[(hs < LEAST_WEIGHT) | (hr < LEAST_WEIGHT)] = 0
            cut = gain.argmax(1)
            for k in np.flatnonzero(gain[np.arange(len(level)), cut] > best + 1e-9):
                best[k], choice[k] = gain[k, cut[k]], (f, int(cut[k]))
        following = []
        for k, node in enumerate(level):
            if choice[k] is None:
                continue
            f, c = choice[k]
            children = len(nodes), len(nodes) + 1
            nodes.extend([[0, 0.0, i, i, 0.0] for i in children])
            nodes[node] = [f, edges[f][c], *children, 0.0]
            following += children
            rows = np.flatnonzero(at == node)
            at[rows] = np.where(bins[rows, f] <= c, *children)
        level = following
        if not level:
            break
    return np.array([n[4] for n in nodes])[at]


def fit_quality(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = FIT_ROWS) -> Trees:
    """Fit on a bounded sample. Its statistics, ``rows`` short rows at most, come to the driver."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                x = statistics(*string_parts(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["label", "x"]
                )

    sample = labelled(docs, labels, "quality", usable, rows).mapInArrow(run, "label int, x array<double>").toArrow()
    y = sample.column("label").to_numpy().astype(float)
    x = np.array(sample.column("x").to_pylist(), float).reshape(len(y), -1) if len(y) else np.zeros((0, 1))
    # Arrival order differs from run to run; sums of floats should not.
    order = np.lexsort([y, *x.T])
    return fit(x[order], y[order])


def quality_score(trees: Trees, text: str = "text") -> Column:
    """Scores between 0 and 1 as a column."""

    @F.arrow_udf(DoubleType())
    def score(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        parts = [trees.scores(statistics(*string_parts(p.column("text")))) for p in slices(batch, "text", PART_BYTES)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(F.col(text))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    held_out = id_remainder(5) == 0
    trees = fit_quality(docs, labels, id_remainder(5) != 0)
    rows = docs.select("doc_id", held_out.alias("held_out"), quality_score(trees).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are scored as good, all columns as they were."""
    trees = fit_quality(docs, labels, id_remainder(5) != 0)
    return docs.filter(quality_score(trees) >= threshold)
