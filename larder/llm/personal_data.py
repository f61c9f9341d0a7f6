"""Personal data in whole texts: fixed patterns, and a tagger that adds what they miss.

The tagger is a character-level bidirectional LSTM with CRF transitions, in numpy.
It is trained on windows around the spans that the patterns label in a bounded sample
of documents (``FIT_ROWS``), each span also in other spellings (``respelled``), and on
windows without any. Every character of every text is then read in overlapping windows.
Each window is decoded by itself; a position takes its tag from the window in which it
lies farthest from an edge, and spans are runs of equal tags over the whole document,
so none ends at a window's edge. A span of the tagger counts if it has what its kind
needs (four numbers, a check digit, ...) and touches no span of the patterns.

Pattern spans stay as they are whatever the tagger says. Texts are read where they lie:
there is no shuffle, and memory follows the window batch and the longest text.

Defined results: a NULL or empty text has no spans. Rows with equal or NULL ids are
rows like any other. Without labelled spans in the sample the tagger adds nothing.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.samples import FIT_ROWS
from larder.llm.text import slices

Span = tuple[int, int]

# ---- patterns -----------------------------------------------------------------

# Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match inside a run of digits is one from its first digit, so no start is tried twice.
ADDRESS = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGITS = re.compile(r"[^0-9]+")


def emails(text: str) -> list[Span]:
    """A name is the run before its @, so texts are read once, however long their words are."""
    found, end, last = [], 0, -1
    at = text.find("@")
    while at >= 0:
        before = text[max(end, last + 1) : at]
        name = len(before) - len(before.rstrip(LOCAL))
        host = HOST.match(text, at) if name else None
        if host:
            end = host.end()
            found.append((at - name, end))
        last = at
        at = text.find("@", at + 1)
    return found


def passes_check_digit(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def is_byte(digits: str) -> bool:
    """At most 255, with any number of leading zeros."""
    return len(digits.lstrip("0")) <= 3 and int(digits[-3:]) <= 255 if len(digits) > 3 else int(digits) <= 255


def addresses(text: str) -> list[Span]:
    return [m.span() for m in ADDRESS.finditer(text) if all(map(is_byte, m.groups()))]


def cards(text: str) -> list[Span]:
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = NO_DIGITS.sub("", m.group())
        if 13 <= len(digits) <= 19 and passes_check_digit(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(NO_DIGITS.sub("", m.group())) <= 15]


def base_spans(text: str) -> list[list[Span]]:
    """Spans of the patterns, a list per kind."""
    return [emails(text), addresses(text), cards(text), phones(text)]


def listed(spans: Iterable[list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, of_kind in zip(KINDS, spans) for a, b in of_kind)


# ---- training windows -----------------------------------------------------------

# Characters around a span that the tagger learns from.
AROUND = 60
WINDOWS_A_KIND = 1000
PLAIN, NUMBERS = len(KINDS), len(KINDS) + 1
DIGIT_RUN = re.compile(r"[0-9]+(?:[^A-Za-z\s]?[0-9]+)*")


def one_of(items: list, text: str):
    """An item by the text's hash, so that reruns choose alike."""
    return items[int.from_bytes(hashlib.blake2b(text[:4096].encode(), digest_size=8).digest()) % len(items)]


def teaching_windows(text: str) -> Iterator[tuple[int, str, int, int]]:
    """(kind, window, start, end): a span of each kind, and places without spans."""
    spans = base_spans(text)
    taken = sorted(s for of_kind in spans for s in of_kind)
    for kind, of_kind in enumerate(spans):
        if of_kind:
            a, b = one_of(of_kind, text)
            start = max(0, a - AROUND)
            yield kind, text[start : min(len(text), b + AROUND)], a - start, b - start
    clean = [(m.start(), m.end()) for m in DIGIT_RUN.finditer(text)]
    clean = [s for s in clean if not overlaps(s, taken)]
    places = [(NUMBERS, one_of(clean, text)[0])] if clean else []
    places.append((PLAIN, one_of(range(len(text)), text)))
    for kind, at in places:
        start, end = max(0, at - AROUND), at + AROUND
        # Spans in sight would be taught as none.
        if not overlaps((start, end), taken):
            yield kind, text[start:end], 0, 0


def overlaps(span: Span, taken: list[Span]) -> bool:
    return any(a < span[1] and span[0] < b for a, b in taken)


def teaching_rows(docs: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(kind, at, span, ...) of at most ``rows`` documents and ``WINDOWS_A_KIND`` windows a kind, by hash."""
    total = docs.count()
    cells = 1 << 30
    share = min(1.0, rows / max(1, total))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(cells)) < round(share * cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [w for t in part.column("text").to_pylist() if t for w in teaching_windows(t)]
                columns = list(zip(*found)) or [()] * 4
                types = (pa.int32(), pa.string(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["kind", "piece", "start", "end"]
                )

    pieces = chosen.select("text").mapInArrow(run, "kind int, piece string, start int, end int").distinct()
    order = Window.partitionBy("kind").orderBy(F.xxhash64("piece", "start"), "piece", "start", "end")
    return pieces.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= WINDOWS_A_KIND)


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def respelled(kind: int, span: str, dice: random.Random) -> str:
    """A span as people write it, among others in ways that the patterns do not know."""
    span = "".join(str(dice.randrange(10)) if c.isdigit() and dice.random() < 0.5 else c for c in span)
    if KINDS[kind] == "email":
        name, host = span.rsplit("@", 1)
        span = "".join(dice.choice(LETTERS) if c in LETTERS and dice.random() < 0.4 else c for c in name) + "@" + host
    if dice.random() < 0.35:
        return span
    digits = NO_DIGITS.sub("", span)
    if KINDS[kind] == "email":
        name, host = span.rsplit("@", 1)
        at = dice.choice([" at ", " [at] ", "(at)", " (at) ", " @ ", "[at]", " AT "])
        dot = dice.choice([".", ".", " dot ", "[dot]", " (dot) ", " . "])
        return name + at + host.replace(".", dot)
    if KINDS[kind] == "ip":
        return span.replace(".", dice.choice(["[.]", " . ", "(.)", "-", ",", " dot "]))
    if KINDS[kind] == "card":
        between = dice.choice([".", "/", "  ", " - ", "_", " ", "-"])
        return between.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    short = digits[-10:]
    forms = [
        f"({short[:3]}) {short[3:6]}-{short[6:]}",
        f"{short[:3]}-{short[3:6]}-{short[6:]}",
        f"{short[:3]}.{short[3:6]}.{short[6:]}",
        f"{short[:3]} {short[3:6]} {short[6:]}",
        f"00{digits[:-10]} {short[:3]} {short[3:6]} {short[6:]}",
        f"+{digits[:-10]}/{short[:3]}/{short[3:]}",
    ]
    return dice.choice(forms)


# ---- the network ----------------------------------------------------------------

TAGS = 1 + len(KINDS)
HIDDEN = 8
EMBEDDED = 8
# ASCII, letters beyond it, everything else, and what lies outside the text.
CLASSES = 131
OUTSIDE = 130
ROUNDS = 700
BATCH = 96
LENGTH = 112
RATE = 0.012


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    beyond = np.where(((points >= 0xC0) & (points < 0x2000)) | (points >= 0x3040), 128, 129)
    return np.where(points < 128, points, beyond).astype(np.uint8)


@dataclass
class Tagger:
    """Weights: embedding, gates and outputs of both directions, transitions.

    Gates are in the order input, forget, output, candidate. The first three are
    clipped lines instead of logistic curves, which numpy has in one step.
    """

    embedding: np.ndarray  # EMBEDDED x CLASSES
    gates: list[np.ndarray]  # 4 HIDDEN x (HIDDEN + EMBEDDED + 1), forwards and backwards
    outputs: list[np.ndarray]  # TAGS x HIDDEN
    bias: np.ndarray
    moves: np.ndarray  # TAGS x TAGS, from and to

    @classmethod
    def new(cls, seed: int) -> Tagger:
        dice = np.random.default_rng(seed)

        def small(*shape: int) -> np.ndarray:
            return dice.normal(0, shape[-1] ** -0.5, shape).astype(np.float32)

        gates = [small(4 * HIDDEN, HIDDEN + EMBEDDED + 1) for _ in range(2)]
        for g in gates:
            g[:, -1] = 0
            g[HIDDEN : 2 * HIDDEN, -1] = 2  # remember at first
        return cls(
            dice.normal(0, 0.5, (EMBEDDED, CLASSES)).astype(np.float32),
            gates,
            [small(TAGS, HIDDEN) for _ in range(2)],
            np.zeros((TAGS, 1), np.float32),
            np.zeros((TAGS, TAGS), np.float32),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.gates, *self.outputs, self.bias, self.moves]

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Scores, time x tag x window, of windows given as time x window."""
        length, count = x.shape
        scores = np.empty((length, TAGS, count), np.float32)
        scores[:] = self.bias
        places = x.astype(np.intp)
        size = HIDDEN
        # As arrays: numpy compares those many times faster than single numbers.
        zeros, ones = np.zeros((3 * size, count), np.float32), np.ones((3 * size, count), np.float32)
        for gates, outputs, times in zip(self.gates, self.outputs, (range(length), range(length - 1, -1, -1))):
            # Clipped lines: 0.25 z + 0.5 between 0 and 1, folded into the weights.
            folded = gates.copy()
            folded[: 3 * size] *= 0.25
            folded[: 3 * size, -1] += 0.5
            inputs = np.ones((size + EMBEDDED + 1, count), np.float32)
            hidden = inputs[:size]
            hidden[:] = 0
            cell = np.zeros((size, count), np.float32)
            z = np.empty((4 * size, count), np.float32)
            tag = np.empty((TAGS, count), np.float32)
            for t in times:
                np.take(self.embedding, places[t], 1, inputs[size : size + EMBEDDED], "clip")
                np.matmul(folded, inputs, out=z)
                sigmoids, candidate = z[: 3 * size], z[3 * size :]
                np.maximum(sigmoids, zeros, out=sigmoids)
                np.minimum(sigmoids, ones, out=sigmoids)
                np.tanh(candidate, out=candidate)
                candidate *= z[:size]
                cell *= z[size : 2 * size]
                cell += candidate
                np.tanh(cell, out=hidden)
                hidden *= z[2 * size : 3 * size]
                np.matmul(outputs, hidden, out=tag)
                scores[t] += tag
        return scores

    def tags(self, x: np.ndarray) -> np.ndarray:
        """The best path of each window, time x window."""
        scores = self.emissions(x)
        best = np.zeros(x.shape, np.uint8)
        open_windows = np.flatnonzero(most_to_gain(scores, self.moves) > 0)
        if len(open_windows):
            best[:, open_windows] = decoded(scores[:, :, open_windows], self.moves)
        return best


def most_to_gain(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """At least what the best path of each window gains over the path that tags nothing.

    Runs of other tags are bounded by their best tag and best moves at every place.
    Where nothing is to be gained, nothing is tagged, and no path need be searched for.
    """
    moves = moves - moves[0, 0]
    enter, leave, stay = moves[0, 1:].max(), moves[1:, 0].max(), moves[1:, 1:].max()
    gain = scores[:, 1:].max(1) - scores[:, 0]
    run = gain[0].copy()
    best = run + leave
    for t in range(1, len(gain)):
        run += stay
        run = np.maximum(run, np.full_like(run, enter)) + gain[t]
        best = np.maximum(best, run + leave)
    return np.maximum(best, run)


def decoded(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Viterbi over time x tag x window."""
    length, _, count = scores.shape
    came = np.zeros((length, TAGS, count), np.uint8)
    path = scores[0]
    for t in range(1, length):
        steps = path[:, None, :] + moves[:, :, None]
        came[t] = steps.argmax(0)
        path = steps.max(0) + scores[t]
    best = np.zeros((length, count), np.uint8)
    best[-1] = path.argmax(0)
    windows = np.arange(count)
    for t in range(length - 1, 0, -1):
        best[t - 1] = came[t, best[t], windows]
    return best


# ---- training ---------------------------------------------------------------------


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis))


def loss_and_slopes(tagger: Tagger, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Negative log-likelihood of the CRF per character, and its slope for every weight."""
    length, count = x.shape
    size = HIDDEN
    scores = np.empty((length, TAGS, count), np.float32)
    scores[:] = tagger.bias
    embedded = tagger.embedding[:, x]  # EMBEDDED x time x window
    kept = []
    directions = (range(length), range(length - 1, -1, -1))
    for gates, outputs, times in zip(tagger.gates, tagger.outputs, directions):
        hidden, cell = np.zeros((size, count), np.float32), np.zeros((size, count), np.float32)
        steps = []
        for t in times:
            inputs = np.concatenate([hidden, embedded[:, t], np.ones((1, count), np.float32)])
            z = gates @ inputs
            sigmoids = np.clip(0.25 * z[: 3 * size] + 0.5, 0, 1)
            candidate = np.tanh(z[3 * size :])
            before = cell
            cell = sigmoids[size : 2 * size] * before + sigmoids[:size] * candidate
            bent = np.tanh(cell)
            hidden = sigmoids[2 * size :] * bent
            scores[t] += outputs @ hidden
            steps.append((t, inputs, sigmoids, candidate, before, bent, hidden))
        kept.append(steps)

    forward = np.empty((length, TAGS, count), np.float32)
    backward = np.zeros((length, TAGS, count), np.float32)
    moves = tagger.moves[:, :, None]
    forward[0] = scores[0]
    for t in range(1, length):
        forward[t] = scores[t] + log_sum(forward[t - 1][:, None] + moves, 0)
    for t in range(length - 2, -1, -1):
        backward[t] = log_sum(moves + (scores[t + 1] + backward[t + 1])[None], 1)
    whole = log_sum(forward[-1], 0)
    slope = np.exp(forward + backward - whole)
    windows = np.arange(count)
    true = scores[np.arange(length)[:, None], y, windows].sum() + tagger.moves[y[:-1], y[1:]].sum()
    slope[np.arange(length)[:, None], y, windows] -= 1
    slope /= length * count
    pairs = np.exp(
        forward[:-1, :, None] + moves[None] + (scores[1:] + backward[1:])[:, None] - whole
    ).sum((0, 3)) / (length * count)
    np.subtract.at(pairs, (y[:-1], y[1:]), 1 / (length * count))

    to_embedding = np.zeros_like(embedded)
    to_gates, to_outputs = [], []
    for gates, outputs, steps in zip(tagger.gates, tagger.outputs, kept):
        gate_slope, output_slope = np.zeros_like(gates), np.zeros_like(outputs)
        to_hidden, to_cell = np.zeros((size, count), np.float32), np.zeros((size, count), np.float32)
        for t, inputs, sigmoids, candidate, before, bent, hidden in reversed(steps):
            output_slope += slope[t] @ hidden.T
            to_hidden = to_hidden + outputs.T @ slope[t]
            to_cell = to_cell + to_hidden * sigmoids[2 * size :] * (1 - bent**2)
            to_sigmoids = np.concatenate([to_cell * candidate, to_cell * before, to_hidden * bent])
            to_sigmoids *= 0.25 * ((sigmoids > 0) & (sigmoids < 1))
            to_z = np.concatenate([to_sigmoids, to_cell * sigmoids[:size] * (1 - candidate**2)])
            gate_slope += to_z @ inputs.T
            back = gates.T @ to_z
            to_hidden, to_cell = back[:size], to_cell * sigmoids[size : 2 * size]
            to_embedding[:, t] += back[size : size + EMBEDDED]
        to_gates.append(gate_slope)
        to_outputs.append(output_slope)
    embedding_slope = np.zeros_like(tagger.embedding.T)
    np.add.at(embedding_slope, x.ravel(), to_embedding.reshape(EMBEDDED, -1).T)
    slopes = [embedding_slope.T, *to_gates, *to_outputs, slope.sum((0, 2))[:, None], pairs]
    return float((whole.sum() - true) / (length * count)), slopes


def drawn(windows: list[tuple[int, str, int, int]], dice: random.Random) -> tuple[np.ndarray, np.ndarray]:
    """A training window and its tags: the span respelled, the place in the window at random."""
    kind, piece, start, end = dice.choice(windows)
    tag, span = 0, piece[start:end]
    if end > start:
        tag, span = kind + 1, respelled(kind, span, dice)
    before, after = piece[:start], piece[end:]
    if dice.random() < 0.1:
        before = ""
    if dice.random() < 0.1:
        after = ""
    x = classes(before + span + after)
    y = np.zeros(len(x), np.uint8)
    y[len(before) : len(before) + len(span)] = tag
    skip = dice.randrange(0, max(1, min(len(before), len(x) - LENGTH) + 1)) if len(x) > LENGTH else 0
    x, y = x[skip : skip + LENGTH], y[skip : skip + LENGTH]
    left = dice.randrange(LENGTH - len(x) + 1)
    full_x, full_y = np.full(LENGTH, OUTSIDE, np.uint8), np.zeros(LENGTH, np.uint8)
    full_x[left : left + len(x)], full_y[left : left + len(x)] = x, y
    return full_x, full_y


def trained(windows: list[tuple[int, str, int, int]], rounds: int = ROUNDS, seed: int = 1) -> Tagger | None:
    """A tagger fitted to the windows; None if they hold no span."""
    kinds = [[w for w in windows if w[0] == k] for k in range(NUMBERS + 1)]
    if not any(kinds[: len(KINDS)]):
        return None
    # Kinds in equal parts; half of the windows have no span.
    decks = [d for d in kinds[: len(KINDS)] if d]
    plain = [d for d in kinds[len(KINDS) :] if d]
    dice = random.Random(seed)
    tagger = Tagger.new(seed)
    means = [(np.zeros_like(w), np.zeros_like(w)) for w in tagger.weights]
    for step in range(1, rounds + 1):
        share = 0.5 if plain else 0.0
        batch = [drawn(dice.choice(plain if dice.random() < share else decks), dice) for _ in range(BATCH)]
        x, y = (np.array(part).T for part in zip(*batch))
        _, slopes = loss_and_slopes(tagger, x, y)
        rate = RATE * min(1.0, step / 20) * (1 - 0.95 * step / rounds)
        for w, (first, second), s in zip(tagger.weights, means, slopes):
            np.clip(s, -1, 1, out=s)
            first += 0.1 * (s - first)
            second += 0.01 * (s * s - second)
            w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return tagger


def fitted(docs: DataFrame, rows: int = FIT_ROWS) -> Tagger | None:
    found = teaching_rows(docs, rows).select("kind", "piece", "start", "end").collect()
    return trained(sorted(tuple(r) for r in found))


# ---- tagging whole texts ------------------------------------------------------------

WINDOW = 448
STEP = 384
# Windows that wait for each other, and of these those of like length that are read at once.
WAITING = 4096
AT_ONCE = 1024


def owned(start: int, length: int) -> Span:
    """The positions that lie farther from the edges of this window than of any other."""
    margin = (WINDOW - STEP) // 2
    first = 0 if start == 0 else start + margin
    last = length if start + WINDOW >= length else start + WINDOW - margin
    return first, last


def runs(tags: np.ndarray, start: int, length: int) -> list[tuple[int, int, int]]:
    """(start, end, tag) of the runs in the part that a window owns, as places in the text."""
    first, last = owned(start, length)
    line = np.zeros(last - first + 2, int)
    line[1:-1] = tags[first - start : last - start]
    edges = np.flatnonzero(np.diff(line))
    return [(first + int(a), first + int(b), int(line[a + 1])) for a, b in zip(edges[:-1], edges[1:]) if line[a + 1]]


def tagged(tagger: Tagger, texts: list[str]) -> list[list[list[Span]]]:
    """Spans by document and kind, windows of all documents read in common batches."""
    found: list[list[list[Span]]] = [[[] for _ in KINDS] for _ in texts]
    waiting: list[tuple[int, int, np.ndarray]] = []
    pieces: dict[int, list[tuple[int, int, int]]] = {}

    def read() -> None:
        waiting.sort(key=lambda w: len(w[2]))
        for first in range(0, len(waiting), AT_ONCE):
            group = waiting[first : first + AT_ONCE]
            x = np.full((len(group[-1][2]), len(group)), OUTSIDE, np.uint8)
            for k, (_, _, part) in enumerate(group):
                x[: len(part), k] = part
            tags = tagger.tags(x)
            for k in np.flatnonzero(tags.any(0)):
                number, start, _ = group[k]
                pieces.setdefault(number, []).extend(runs(tags[:, k], start, len(texts[number])))
        waiting.clear()

    for number, text in enumerate(texts):
        # A giant text's characters are taken block by block.
        for block in range(0, len(text), STEP * AT_ONCE):
            x = classes(text[block : block + STEP * AT_ONCE + WINDOW])
            for start in range(0, min(len(text) - block, STEP * AT_ONCE), STEP):
                if block + start and block + start + WINDOW - STEP >= len(text):
                    break  # the window before holds the rest
                waiting.append((number, block + start, x[start : start + WINDOW]))
                if len(waiting) == WAITING:
                    read()
    if waiting:
        read()
    for number, parts in pieces.items():
        joined: list[list[int]] = []
        for a, b, tag in sorted(parts):
            if joined and joined[-1][1] == a and joined[-1][2] == tag:
                joined[-1][1] = b
            else:
                joined.append([a, b, tag])
        for a, b, tag in joined:
            found[number][tag - 1].append((a, b))
    return found


AT = r"(?:\x20?@\x20?|\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20at\x20)"
DOT = r"(?:\x20?\.\x20?|\x20?[\[({<]\x20?dot\x20?[\])}>]\x20?|\x20dot\x20)"
SPELLED_EMAIL = re.compile(rf"[a-z0-9._%+-]+{AT}[a-z0-9-]+(?:{DOT}[a-z0-9-]+)+", re.IGNORECASE | re.ASCII)
NUMBERS_ONLY = re.compile(r"[0-9+()\[\]./_,\s-]+")


def whole_words(text: str, span: Span) -> Span:
    """The span from a letter, digit, + or ( to a letter or digit, and to the ends of words that it touches."""
    a, b = span
    while a < b and not (text[a].isalnum() or text[a] in "+("):
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    while a < b and 0 < a and text[a].isalnum() and text[a - 1].isalnum():
        a -= 1
    while a < b < len(text) and text[b].isalnum():
        b += 1
    return a, b


def settled(kind: str, text: str, span: Span) -> Span | None:
    """The exact limits of a span of the tagger, or None where it has not what its kind needs."""
    a, b = whole_words(text, span)
    inside = text[a:b]
    if kind == "email":
        # The name as the patterns take it: all that may belong to it.
        name = text[max(0, a - 2 * WINDOW) : a]
        a -= len(name) - len(name.rstrip(LOCAL))
        found = SPELLED_EMAIL.search(text[a:b])
        return (a + found.start(), a + found.end()) if found else None
    digits = NO_DIGITS.sub("", inside)
    if kind == "ip":
        groups = re.findall("[0-9]+", inside)
        fits = len(groups) == 4 and all(len(g) <= 3 and is_byte(g) for g in groups)
    elif kind == "card":
        fits = NUMBERS_ONLY.fullmatch(inside) and 13 <= len(digits) <= 19 and passes_check_digit(digits)
    else:
        fits = NUMBERS_ONLY.fullmatch(inside) and 9 <= len(digits) <= 15
    return (a, b) if fits else None


def all_spans(text: str, base: list[list[Span]], seen: list[list[Span]]) -> list[list[Span]]:
    """The patterns' spans, and those of the tagger that are whole and lie apart from them."""
    taken = [s for of_kind in base for s in of_kind]
    out = []
    for kind, of_base, of_tagger in zip(KINDS, base, seen):
        more: list[Span] = []
        for span in of_tagger:
            exact = settled(kind, text, span)
            if exact and not overlaps(exact, taken) and not overlaps(exact, more):
                more.append(exact)
        out.append(sorted(of_base + more))
    return out


def personal_data(docs: DataFrame, tagger: Tagger | None = None, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added: a row per document."""
    texts = docs.select("doc_id", "text")
    tagger = tagger or fitted(texts, rows)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines = [t or "" for t in part.column("text").to_pylist()]
                base = [base_spans(t) for t in lines]
                seen = tagged(tagger, lines) if tagger else [[[] for _ in KINDS] for _ in lines]
                whole = [all_spans(t, b, s) for t, b, s in zip(lines, base, seen)]
                columns = [part.column("doc_id")]
                columns += [pa.array([len(b[k]) for b in base], pa.int64()) for k in range(len(KINDS))]
                columns.append(pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string()))
                columns.append(pa.array([listed(w) for w in whole], pa.string()))
                added = [sum(map(len, w)) - sum(map(len, b)) for w, b in zip(whole, base)]
                columns.append(pa.array(added, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", *counts, "base_sha256", "spans", "n_added"]
                )

    schema = ", ".join(f"{c} long" for c in counts)
    return texts.mapInArrow(run, f"doc_id {kind}, {schema}, base_sha256 string, spans string, n_added long")
