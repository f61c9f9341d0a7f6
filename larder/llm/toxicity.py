"""Toxic documents by misspelling-tolerant terms in their context.

Terms are the words that labelled documents show to be toxic. They form a trie; a
Levenshtein automaton runs along it, so one pass over a word finds every term
within one edit (two for terms of eight letters or more). The states of trie and
automaton together are made deterministic as words ask for them. A hit counts by
its distance, and by its context: other hits nearby and second-person words raise
it, quotation marks around it or words of reporting lower it. A logistic model
over these sums gives the score.

Terms and weights are learned from a bounded sample of labelled rows
(``samples.FIT_ROWS``); every whole text is scored where it lies.

Defined results: NULL texts count as empty; an empty text gets the score of a text
without hits; without usable labels there are no terms and every score is alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from larder.llm.samples import FIT_ROWS, id_remainder, labelled
from larder.llm.text import slices

# Terms: at most so many, in toxic texts after at least so many different words (also as
# a share of the toxic texts), and so many times likelier there.
TERMS = 500
LEAST_CONTEXTS = 8
LEAST_SHARE = 0.01
LEAST_RATIO = 8.0
SHORTEST = 4
WINDOW = 8
WINDOW_CHARS = 48
DISTANCE_WEIGHT = (1.0, 0.6, 0.4)
RIDGE = 1e-2
SEEN_WORDS = 400_000

# Marks, letters and words that the context rules look for.
OPENING = "\"“„«‘'`"
CLOSING = "\"”“»’'`"
LOOKALIKE = str.maketrans("013457@$!", "oieastasi")
REPORTING = {"said", "says", "called", "calls", "word", "words", "term", "quote", "quoted", "wrote", "means", "meaning"}
ADDRESS = {"you", "your", "you're", "youre", "ur", "u", "du", "dich", "tu", "te", "usted", "vous"}
WORD = re.compile(r"\w+")
TOKEN = re.compile(r"\S+")


def allowed_edits(term: str) -> int:
    return 0 if len(term) < SHORTEST else 1 if len(term) < 8 else 2


class FuzzyLexicon:
    """Levenshtein automata along a trie of terms, made deterministic on demand."""

    def __init__(self, terms: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.allowed = [0]
        for word in sorted(set(terms)):
            node = 0
            self.allowed[0] = max(self.allowed[0], allowed_edits(word))
            for letter in word:
                step = self.children[node].get(letter)
                if step is None:
                    step = self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.allowed.append(0)
                node = step
                self.allowed[node] = max(self.allowed[node], allowed_edits(word))
            self.term[node] = word
        self.letters = {letter for c in self.children for letter in c}
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, least: dict[int, int]) -> int:
        """The state with these trie nodes at their fewest edits, closed under skipped letters."""
        queue = list(least)
        while queue:
            node = queue.pop()
            for step in self.children[node].values():
                edits = least[node] + 1
                if edits <= self.allowed[step] and edits < least.get(step, 99):
                    least[step] = edits
                    queue.append(step)
        key = frozenset(least.items())
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.members)
            self.members.append(key)
            self.moves.append({})
            ends = [
                (edits, self.term[node])
                for node, edits in least.items()
                if self.term[node] is not None and edits <= allowed_edits(self.term[node])
            ]
            best = min(ends, default=None)
            self.found.append(best and (best[1], best[0]))
        return number

    def _move(self, state: int, letter: str) -> int:
        least: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.allowed[node] and edits < least.get(node, 99):
                least[node] = edits

        for node, edits in self.members[state]:
            reach(node, edits + 1)
            for other, step in self.children[node].items():
                reach(step, edits + (other != letter))
        return self._state(least) if least else -1

    def nearest(self, word: str) -> tuple[str, int] | None:
        """The term with the fewest edits (then the first in order), if within its limit."""
        state = self.start
        for letter in word:
            if letter not in self.letters:
                letter = ""
            step = self.moves[state].get(letter)
            if step is None:
                step = self.moves[state][letter] = self._move(state, letter)
            if step < 0:
                return None
            state = step
        return self.found[state]


def spellings(token: str) -> set[str]:
    """Forms of a token to look up: stripped, its parts, without drawn-out or look-alike letters."""
    forms = {token.strip("\"'`.,;:!?()[]{}<>*_-“”„«»‘’…"), *WORD.findall(token)}
    forms |= {re.sub(r"(.)\1{2,}", r"\1", f) for f in forms}
    return {f for f in forms | {f.translate(LOOKALIKE) for f in forms} if f}


@dataclass
class Detector:
    terms: list[str]
    ordinary: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.zeros(5))

    def __post_init__(self):
        self.lexicon = FuzzyLexicon(self.terms)
        self.seen: set[str] = set()
        self.hits: dict[str, tuple[str, int]] = {}

    def look_up(self, tokens: set[str]) -> set[str]:
        """The tokens that are near a term. Each distinct token is matched once."""
        if len(self.seen) > SEEN_WORDS:
            self.seen = set()
        for token in tokens - self.seen:
            found = [(f, self.lexicon.nearest(f)) for f in spellings(token)]
            near = [(hit[1], hit[0]) for f, hit in found if hit and (hit[1] == 0 or f not in self.ordinary)]
            if near:
                edits, term = min(near)
                self.hits[token] = (term, edits)
            self.seen.add(token)
        return {t for t in tokens if t in self.hits}

    def context(self, text: str, spans: list[tuple[int, int]], tokens: list[str], i: int, hits: set[str]) -> tuple[bool, float]:
        """Whether hit ``i`` is quoted or reported, and how its neighbours raise it."""
        start, end = spans[i]
        before, after = text[max(0, start - WINDOW_CHARS) : start], text[end : end + WINDOW_CHARS]
        own = text[start:end]
        opened = own[0] in OPENING or _open_mark(before)
        closed = own.rstrip(".,;:!?")[-1:] in set(CLOSING) or any(c in CLOSING for c in after if c != "'")
        near = [t.strip(".,;:!?\"'") for t in tokens[max(0, i - WINDOW) : i] + tokens[i + 1 : i + 1 + WINDOW]]
        reported = any(t in REPORTING for t in near[:WINDOW])
        others = sum(t in hits for t in near)
        return (opened and closed) or reported, 1 + 0.25 * min(others, 4) + 0.25 * any(t in ADDRESS for t in near)

    def features(self, text: str) -> list[float]:
        lowered = text.lower()
        hits = self.look_up(set(lowered.split()))
        if not hits:
            return [1.0, 0.0, 0.0, 0.0, 0.0]
        spans = [m.span() for m in TOKEN.finditer(lowered)]
        tokens = [lowered[a:b] for a, b in spans]
        direct = quoted = 0.0
        for i, token in enumerate(tokens):
            if token in hits:
                reported, raised = self.context(lowered, spans, tokens, i, hits)
                strength = DISTANCE_WEIGHT[self.hits[token][1]] * raised
                if reported:
                    quoted += strength
                else:
                    direct += strength
        share = 100 * direct / len(tokens)
        return [1.0, math.log1p(direct), min(direct, 1.0), math.log1p(quoted), math.log1p(share)]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def _open_mark(before: str) -> bool:
    """An opening mark that is not closed again before the hit."""
    straight = before.count('"') % 2 == 1
    curled = max(before.rfind(c) for c in "“„«") > max(before.rfind(c) for c in "”»")
    return straight or curled


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; slopes are kept from turning negative, but for quotation."""
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - RIDGE * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        w[[1, 2, 4]] = np.maximum(w[[1, 2, 4]], 0)
        if np.abs(step).max() < 1e-6:
            break
    return w


def words_after(text: str = "text") -> Column:
    """Distinct pairs of a word and the word before it.

    Pairs are told apart as strings, which Spark hashes; it compares each struct with
    all others. Words hold no blank. The list of words is bound, so it is made once.
    """

    def pairs(words: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit("")), words), 1, F.size(words))
        return F.array_distinct(F.zip_with(words, before, lambda w, b: F.concat(w, F.lit(" "), b)))

    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.transform(
        F.transform(F.array(words), pairs)[0],
        lambda p: F.struct(F.substring_index(p, " ", 1).alias("word"), F.substring_index(p, " ", -1).alias("before")),
    )


def fit_detector(docs: DataFrame, labels: DataFrame, usable: Column, rows: int = FIT_ROWS) -> Detector:
    """Learn terms, ordinary words and weights. At most ``TERMS`` terms and ``rows`` short rows reach the driver."""
    sample = labelled(docs, labels, "toxic", usable, rows)
    words = sample.select("label", F.explode(words_after()).alias("w")).select("label", "w.*").filter(F.length("word") >= 3)
    sizes = sample.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    toxic, clean = (n or 0 for n in sizes)
    # A copied text has the same words in the same places, so its rare words have one context each.
    counts = (
        words.groupBy("word", "before")
        .agg(F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("c"))
        .groupBy("word")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count_if(F.col("t") > 0).alias("contexts"))
    )
    ratio = ((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("c") + 0.5) / (clean + 1))
    least = max(LEAST_CONTEXTS, math.ceil(LEAST_SHARE * toxic))
    strong = counts.filter((F.col("contexts") >= least) & (ratio >= LEAST_RATIO))
    terms = [r.word for r in strong.orderBy(F.desc(ratio), "word").select("word").limit(TERMS).collect()]
    finder = Detector(terms)
    usual = sample.filter("label = 0").mapInArrow(_near_words(finder), "word string").distinct()
    ordinary = frozenset(r.word for r in usual.collect())
    detector = Detector(terms, ordinary)

    def run(batches):
        for batch in batches:
            x = [detector.features(t) for part in slices(batch, "text") for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    seen = sample.mapInArrow(run, "label int, x array<double>").toArrow()
    y = seen.column("label").to_numpy().astype(float)
    x = np.array(seen.column("x").to_pylist(), float).reshape(len(y), 5)
    order = np.lexsort([y, *x.T]) if len(y) else np.zeros(0, int)
    return Detector(terms, ordinary, fit_logistic(x[order], y[order]) if len(y) else np.zeros(5))


def _near_words(finder: Detector):
    """Words of clean texts that are near a term without being one."""

    def run(batches):
        for batch in batches:
            near = set()
            for text in (t for part in slices(batch, "text") for t in part.column("text").to_pylist()):
                for token in finder.look_up(set(text.lower().split())):
                    near |= {f for f in spellings(token) if (hit := finder.lexicon.nearest(f)) and hit[1]}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(near), pa.string())], ["word"])

    return run


def toxicity_score(detector: Detector, text: str = "text") -> Column:
    """Scores between 0 and 1 as a column."""

    @F.arrow_udf(DoubleType())
    def score(column: pa.Array) -> pa.Array:
        parts = slices(pa.RecordBatch.from_arrays([column], ["text"]), "text")
        x = [detector.features(t or "") for part in parts for t in part.column("text").to_pylist()]
        return pa.array(detector.score(np.array(x).reshape(-1, 5)))

    return score(F.col(text))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    held_out = id_remainder(3) == 1
    detector = fit_detector(docs, labels, id_remainder(3) != 1)
    rows = docs.select("doc_id", held_out.alias("held_out"), toxicity_score(detector).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that are not scored as toxic, all columns as they were."""
    detector = fit_detector(docs, labels, id_remainder(3) != 1)
    return docs.filter(toxicity_score(detector) < threshold)
