"""How five document filters interact, in every order they could be applied in.

Filters A to D look at one text. E, an exact copy of a smaller id's text, is found
with compressed (radix) tries that hold the smallest id of each whole text at its
terminal node:

1. The heavy top of the corpus's trie is grown level by level, from counts of all
   texts: only branches with more than a fair share of the bytes are split further,
   at the first place where their texts differ. Its leaves, in order, are the ranges.
2. Each task inserts a piece of its rows into a trie of its own. A row with a larger
   id than another row of the same text is settled there; of each text only the rows
   of the smallest id go on, so a text that fills a third of the table reaches its
   range once per piece.
3. Each range inserts what it gets into one trie and reads the flags off its terminals.

What a document fails is then a short word over ABCDE. Words are counted with labels
before anything is spread out to orders, so the rest depends on languages alone.

Defined results: a NULL text is empty, a NULL lang the empty part; an empty text fails
A only, or E too. A NULL id is neither smaller nor larger than any, so such a row never
fails E and is no reason for another to. Rows that repeat an id and its text both stay;
an id with several texts counts by each. Of several labels of an id the largest counts;
a NULL id has none. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.text import slices

LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITAL_PERCENT = 10
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LATER_BYTES = bytes(range(128, 192))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
# Texts beyond this size are taken apart word by word, not all words at once.
LONG_TEXT = 1 << 22

# Texts of a task that share one trie before the shuffle.
PIECE_BYTES = 16 << 20
# Texts of a range, at most, where texts differ; more ranges are made as the table grows.
RANGE_BYTES = 64 << 20
# Every row weighs something in the balance of ranges, if its text is empty.
ROW_BYTES = 64
# Bytes by which a heavy branch is told apart, beyond what its texts share.
BRANCH = 2
# Levels of branches that are split. Balance depends on it, results do not.
LEVELS = 16

ORDERS = ["".join(p) for p in permutations("ABCDE")]


# ---- tries ------------------------------------------------------------------


def shared(a: bytes, b: bytes, at: int = 0) -> int:
    """How many bytes ``a`` shares with ``b`` from ``at`` on."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Whole texts, sharing beginnings; each terminal holds the smallest id seen there."""

    def __init__(self):
        self.labels: list[bytes] = [b""]
        self.children: list[dict[int, int] | None] = [None]
        self.least: list[int | None] = [None]

    def _new(self, label: bytes, children: dict[int, int] | None) -> int:
        self.labels.append(label)
        self.children.append(children)
        self.least.append(None)
        return len(self.labels) - 1

    def terminal(self, text: bytes) -> int:
        """The node where ``text`` ends, made if it is new."""
        labels, children = self.labels, self.children
        node, at, end = 0, 0, len(text)
        while at < end:
            below = children[node]
            if below is None:
                below = children[node] = {}
            child = below.get(text[at])
            if child is None:
                child = below[text[at]] = self._new(text[at:], None)
                return child
            label = labels[child]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            k = shared(label, text, at)
            between = self._new(label[:k], {label[k]: child})
            labels[child] = label[k:]
            below[text[at]] = between
            node, at = between, at + k
        return node

    def insert(self, text: bytes, number: int) -> int:
        node = self.terminal(text)
        if self.least[node] is None or number < self.least[node]:
            self.least[node] = number
        return node


# ---- ranges -----------------------------------------------------------------


@dataclass
class Branch:
    """Texts that begin with ``prefix``: their bytes; ``ends`` if nothing follows it."""

    prefix: bytes
    weight: int
    ends: bool


def split_branches(docs: DataFrame, heavy: list[bytes], fair: int) -> dict[bytes, list[Branch]]:
    """The branches below each of the heavy ones, from all texts.

    At most 65,536 branches a heavy one, and there are no more heavy ones than ranges.
    What the texts of a branch share beyond its own bytes is asked for only where the
    branch weighs more than ``fair``, and so will be split.
    """
    heavy = sorted(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], list] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    text = text or b""
                    # Heavy branches do not lie inside each other, so at most one can be the text's.
                    k = bisect_right(heavy, text) - 1
                    if k < 0 or not text.startswith(heavy[k]):
                        continue
                    at = len(heavy[k])
                    found = seen.get((k, text[at : at + BRANCH]))
                    if found is None:
                        seen[k, text[at : at + BRANCH]] = [len(text) + ROW_BYTES, text]
                        continue
                    found[0] += len(text) + ROW_BYTES
                    if not text.startswith(found[1]):
                        found[1] = text[: shared(found[1], text)]
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in keys], pa.int32()),
                pa.array([b for _, b in keys], pa.binary()),
                pa.array([seen[x][0] for x in keys], pa.int64()),
                pa.array([seen[x][1] for x in keys], pa.binary()),
            ],
            ["k", "branch", "weight", "prefix"],
        )

    parts = docs.select("text").mapInArrow(run, "k int, branch binary, weight long, prefix binary")
    # What all share is what the first and the last in order share.
    sums = parts.groupBy("k", "branch").agg(
        F.sum("weight").alias("weight"), F.min("prefix").alias("first"), F.max("prefix").alias("last")
    )
    below: dict[bytes, list[Branch]] = {prefix: [] for prefix in heavy}
    is_heavy = F.col("weight") > fair
    short = sums.select("k", "branch", "weight", *[F.when(is_heavy, F.col(c)).alias(c) for c in ("first", "last")])
    for row in short.collect():
        prefix = heavy[row["k"]] + bytes(row["branch"])
        if row["first"] is not None:
            first, last = bytes(row["first"]), bytes(row["last"])
            prefix = first[: shared(first, last)]
        below[heavy[row["k"]]].append(Branch(prefix, row["weight"], len(row["branch"]) < BRANCH))
    return below


def range_starts(docs: DataFrame, ranges: int) -> list[bytes]:
    """Where each range but the first begins, so that ranges hold about equal bytes."""
    weight = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES)
    total = docs.agg(F.sum(weight).alias("total")).first()["total"] or 0
    ranges = max(ranges, -(-total // RANGE_BYTES))
    fair = total // (2 * ranges) + 1
    branches = split_branches(docs, [b""], fair)[b""]
    for _ in range(LEVELS):
        heavy = {b.prefix: b for b in branches if b.weight > fair and not b.ends}
        if not heavy:
            break
        below = split_branches(docs, list(heavy), fair)
        branches = [b for b in branches if b.prefix not in heavy] + [b for found in below.values() for b in found]
    starts, filled = [], 0
    for b in sorted(branches, key=lambda b: b.prefix):
        if filled and filled + b.weight > 2 * fair:
            starts.append(b.prefix)
            filled = 0
        filled += b.weight
    return starts


# ---- what each document fails -------------------------------------------------


def failures(text: bytes) -> str:
    """Which of the filters A to D a text fails."""
    if len(text) > LONG_TEXT:
        words, different = 0, set()
        for found in WORD.finditer(text):
            words += 1
            different.add(found.group())
    else:
        listed = text.split()
        words, different = len(listed), set(listed)
    characters = len(text) if text.isascii() else len(text.translate(None, LATER_BYTES))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        "A" * (words < LEAST_WORDS)
        + "B" * (100 * len(different) < LEAST_DISTINCT_PERCENT * words)
        + "C" * (100 * capitals > MOST_CAPITAL_PERCENT * characters)
        + "D" * (len(text.translate(None, SYMBOLS)) < len(text))
    )


def settled_in_tasks(batches: Iterator[pa.RecordBatch], starts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows with what A to D say; the text goes along only where E is open.

    ``range`` is the text's, and any range for rows that are settled.
    """
    settled = 0
    for part in (p for batch in batches for p in slices(batch, "text", PIECE_BYTES)):
        texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
        numbers = part.column("doc_id").to_pylist()
        trie = RadixTrie()
        nodes = [None if n is None else trie.insert(t, n) for n, t in zip(numbers, texts)]
        known: dict[int, tuple[str, int]] = {}
        failed, where, open_texts = [], [], []
        for number, node, text in zip(numbers, nodes, texts):
            if node is None:
                word, place = failures(text), -1
            else:
                if node not in known:
                    known[node] = failures(text), bisect_right(starts, text)
                word, place = known[node]
                if number > trie.least[node]:
                    word, place = word + "E", -1
            if place < 0:
                place = settled % (len(starts) + 1)
                settled += 1
                text = None
            failed.append(word)
            where.append(place)
            open_texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").cast(pa.int64()),
                part.column("part").cast(pa.string()),
                pa.array(failed, pa.string()),
                pa.array(where, pa.int32()),
                pa.array(open_texts, pa.binary()),
            ],
            ["doc_id", "part", "failed", "range", "text"],
        )


def settled_in_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flags of all rows of a range. Of its rows only ids and terminals are held, beside the trie."""
    trie = RadixTrie()
    numbers, nodes = array("q"), array("q")
    parts: dict[str, int] = {}
    words: dict[str, int] = {}
    part_of, word_of = array("q"), array("q")
    names = ["doc_id", "part", "failed"]
    for batch in batches:
        is_open = pa.compute.is_valid(batch.column("text"))
        yield batch.filter(pa.compute.invert(is_open)).select(names)
        for piece in slices(batch.filter(is_open), "text"):
            for text, number, part, word in zip(
                *(piece.column(c).to_pylist() for c in ("text", "doc_id", "part", "failed"))
            ):
                nodes.append(trie.insert(text, number))
                numbers.append(number)
                part_of.append(parts.setdefault(part, len(parts)))
                word_of.append(words.setdefault(word, len(words)))
    part_names, word_names = list(parts), list(words)
    for start in range(0, len(numbers), 10_000):
        rows = range(start, min(start + 10_000, len(numbers)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(numbers[start : rows.stop], pa.int64()),
                pa.array([part_names[part_of[i]] for i in rows], pa.string()),
                pa.array(
                    [word_names[word_of[i]] + "E" * (numbers[i] > trie.least[nodes[i]]) for i in rows], pa.string()
                ),
            ],
            names,
        )


def failed_filters(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """(doc_id, part, failed): a row per document, ``failed`` the filters it fails, as a word over ABCDE."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")
    starts = range_starts(rows, ranges or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def in_tasks(batches):
        return settled_in_tasks(batches, starts)

    sent = rows.mapInArrow(in_tasks, "doc_id long, part string, failed string, range int, text binary")
    return sent.repartitionById(len(starts) + 1, "range").mapInArrow(
        settled_in_ranges, "doc_id long, part string, failed string"
    )


# ---- the report ---------------------------------------------------------------


def failure_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, docs, good, toxic). Rows of an id are counted before they meet its label."""
    rows = failed.groupBy("doc_id", "part", "failed").agg(F.count("*").alias("n"))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic")
    )
    marked = rows.join(marks, "doc_id", "left")
    return marked.groupBy("part", "failed").agg(
        F.sum("n").alias("docs"),
        F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def audit(docs: DataFrame, labels: DataFrame, ranges: int | None = None) -> DataFrame:
    """A row per part, order of the filters and step: what that step's filter does there."""
    counts = failure_counts(failed_filters(docs, ranges), labels)
    order, step, failed = F.col("filter_order"), F.col("step"), F.col("failed")
    spread = counts.select("*", F.explode(F.lit(ORDERS)).alias("filter_order"))
    spread = spread.select("*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("step"))
    spread = spread.withColumn("letter", F.substr(order, step, F.lit(1)))

    def passes(letters):
        return F.call_function("translate", letters, failed, F.lit("")) == letters

    fails_here = F.contains(failed, F.col("letter"))
    came = passes(F.substr(order, F.lit(1), step - 1))

    def total(condition, what="docs"):
        return F.sum(F.when(condition, F.col(what)).otherwise(0))

    steps = spread.groupBy("part", "filter_order", "step", "letter").agg(
        total(passes(F.substr(order, F.lit(1), step))).alias("kept"),
        total(came & fails_here).alias("removed"),
        total(~came & fails_here).alias("redundant"),
        total(failed == F.col("letter")).alias("unique_fails"),
        total(came & fails_here, "good").alias("good_lost"),
        total(came & fails_here, "toxic").alias("toxic_lost"),
    )
    # 600 rows a part.
    everywhere = Window.partitionBy("part", "letter")
    return steps.withColumn("shapley", F.sum("removed").over(everywhere)).drop("letter")
