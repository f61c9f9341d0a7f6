"""SentencePiece encoding and decoding by a max-plus parallel scan.

A BPE model's texts are cut into the pieces that the library merges them to
(``MergedVocabulary``: each word's lattice holds these pieces only). Else a text is
cut into the pieces of the vocabulary with the largest sum of scores (unigram
segmentation); among equal sums, the longest last piece wins, and so on
towards the front. Characters without a piece become their UTF-8 bytes.

Giant texts are split into chunks. A chunk's transfer matrix holds, for each way a
piece can reach into it from the left and out of it on the right, the best score in
between. Matrices combine associatively in the (max, +) algebra, which gives every
chunk the scores at its left edge; with these, each chunk finds on its own which
entry each exit leads back to; these maps are composed from the end, and then each
chunk is traced back on its own. The ids are those of one pass over the whole text.

Scores are integers in the given vocabulary; all sums are exact in 64 bits.

Defined results: NULL and empty texts have no ids and decode to an empty text; the
character that stands for a blank decodes to a blank; repeated rows are encoded
each for itself.
"""

from __future__ import annotations

import re
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.text import slices
from larder.sources.storage import Scratch

BLANK = "▁"
GIANT = 1 << 16
CHUNK = 1 << 14
# Scores are summed as integers in units of a thousandth.
UNIT = 1000
NEVER = -(1 << 60)
UNKNOWN_PENALTY = 10
KNOWN_WORDS = 500_000
LONGEST_KNOWN = 64
WORDS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


class Vocabulary:
    """Pieces and scores of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, int] = {}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = set(self.bytes)
        self.texts: list[bytes] = [b""] * model.get_piece_size()
        for number in range(model.get_piece_size()):
            if number in special:
                self.texts[number] = bytes([self.bytes.index(number)])
            elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
                piece = model.id_to_piece(number)
                self.ids[piece] = number
                self.scores[piece] = round(model.get_score(number) * UNIT)
                self.texts[number] = piece.replace(BLANK, " ").encode()
        self.reach = max(map(len, self.ids))
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY * UNIT
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # Whether a blank only ever opens a piece, so that texts fall into words there.
        self.by_words = not any(b[0] != BLANK and b[1] == BLANK for b in self.inside)
        # Every start of a piece, with its score where it is a piece itself.
        self.starts: dict[str, int | None] = {p[:k]: None for p in self.ids for k in range(1, len(p))}
        self.starts.update(self.scores)
        self.known: dict[str, list[int]] = {}
        self.word_scores: dict[str, int] = {}

    def edges(self, text: str, at: int):
        """(end, score) of each piece that starts at ``at``."""
        if text[at] not in self.scores:
            yield at + 1, self.unknown
        starts = self.starts
        for end in range(at + 1, min(at + self.reach, len(text)) + 1):
            score = starts.get(text[at:end], NEVER)
            if score == NEVER:
                break
            if score is not None:
                yield end, score

    def forward(self, text: str, start: dict[int, int], stop: int) -> tuple[dict[int, int], dict[int, int]]:
        """Best scores of places reached from ``start`` by pieces that begin before ``stop``, and where each piece began.

        A place of ``start`` that keeps its own score has no origin: its last piece
        began further left, and so is longer than any other.
        """
        best, origin = dict(start), {}
        for at in range(min(start), stop):
            if at not in best:
                continue
            here = best[at]
            for end, score in self.edges(text, at):
                if here + score > best.get(end, NEVER):
                    best[end] = here + score
                    origin[end] = at
        return best, origin

    def piece_ids(self, text: str, at: int, end: int) -> list[int]:
        piece = text[at:end]
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.bytes[b] for b in piece.encode()]

    def trace(self, text: str, origin: dict[int, int], end: int) -> tuple[list[int], int]:
        """Ids of the pieces on the way back from ``end``, and the place where it ends."""
        parts = []
        while end in origin:
            parts.append(self.piece_ids(text, origin[end], end))
            end = origin[end]
        return [i for part in reversed(parts) for i in part], end

    def word(self, word: str) -> list[int]:
        ids = self.known.get(word)
        if ids is None:
            ids = self._short(word) if len(word) <= LONGEST_KNOWN else self._whole(word)
            if len(word) <= LONGEST_KNOWN:
                if len(self.known) >= KNOWN_WORDS:
                    self.known = {}
                self.known[word] = ids
        return ids

    def _whole(self, word: str) -> list[int]:
        _, origin = self.forward(word, {0: 0}, len(word))
        return self.trace(word, origin, len(word))[0]

    def _short(self, word: str) -> list[int]:
        """The same as ``_whole``, with lists for dictionaries."""
        starts, size, reach = self.starts, len(word), self.reach
        best, origin = [NEVER] * (size + 1), [0] * (size + 1)
        best[0] = 0
        for at in range(size):
            # Every character can be passed alone, so every place is reached.
            here = best[at]
            if word[at] not in self.scores and here + self.unknown > best[at + 1]:
                best[at + 1], origin[at + 1] = here + self.unknown, at
            for end in range(at + 1, min(at + reach, size) + 1):
                score = starts.get(word[at:end], NEVER)
                if score is None:
                    continue
                if score == NEVER:
                    break
                if here + score > best[end]:
                    best[end], origin[end] = here + score, at
        ids, end = [], size
        while end:
            piece = word[origin[end] : end]
            number = self.ids.get(piece)
            if number is None:
                ids += reversed([self.bytes[b] for b in piece.encode()])
            else:
                ids.append(number)
            end = origin[end]
        ids.reverse()
        return ids

    def encode(self, text: str) -> list[int]:
        """One pass over the whole text."""
        if not text:
            return []
        prepared = prepare(text)
        if not self.by_words:
            return self.word(prepared)
        out: list[int] = []
        for word in WORDS.findall(prepared):
            out += self.known.get(word) or self.word(word)
        return out

    def decode(self, ids) -> str:
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    def chunk_starts(self, text: str, chunk: int) -> list[int]:
        return list(range(0, len(text), chunk))

    # ---- chunks of a giant text: ``text`` goes on ``reach`` places beyond ``size`` ----

    def cuts(self, text: str, size: int) -> tuple[int, int] | None:
        """The first and last place that no piece can cross, left of which every entry lies."""
        low, high = self.reach, size
        while low < high and text[low - 1 : low + 1] in self.inside:
            low += 1
        while high > low and (high >= len(text) or text[high - 1 : high + 1] in self.inside):
            high -= 1
        return (low, high) if low < high else None

    def transfer(self, text: str, size: int) -> np.ndarray:
        """Best scores from each entry (places into the chunk) to each exit (places beyond it)."""
        cuts = self.cuts(text, size)
        middle, tail_start = (0, None) if cuts is None else (self._score(text[cuts[0] : cuts[1]]), cuts[1])
        stop = size if cuts is None else cuts[0]
        rows = []
        for entry in range(self.reach):
            if entry >= size:
                rows.append([0 if entry - size == k else NEVER for k in range(self.reach)])
                continue
            best, _ = self.forward(text, {entry: 0}, stop)
            if cuts is None:
                rows.append([best.get(size + k, NEVER) for k in range(self.reach)])
            else:
                rows.append(best.get(cuts[0], NEVER))
        if cuts is None:
            return np.array(rows, np.int64)
        best, _ = self.forward(text, {tail_start: 0}, size)
        tail = np.array([best.get(size + k, NEVER) for k in range(self.reach)], np.int64)
        return combine(np.array(rows, np.int64)[:, None], tail[None, :] + np.where(tail > NEVER // 2, middle, 0))

    def _score(self, text: str) -> int:
        """The best score of a text between two places that no piece crosses."""
        total, scores = 0, self.word_scores
        if len(scores) > KNOWN_WORDS:
            scores.clear()
        for word in WORDS.findall(text) if self.by_words else [text]:
            score = scores.get(word)
            if score is None:
                best, _ = self.forward(word, {0: 0}, len(word))
                score = best[len(word)]
                if len(word) <= LONGEST_KNOWN:
                    scores[word] = score
            total += score
        return total

    def entered(self, text: str, size: int, entry: np.ndarray):
        start = {k: int(v) for k, v in enumerate(entry) if v > NEVER // 2}
        inside = {k: v for k, v in start.items() if k <= size}
        best, origin = self.forward(text, inside, size)
        # An entry beyond the chunk is an exit as it stands.
        for k, v in start.items():
            if k > size and v >= best.get(k, NEVER):
                best[k] = v
                origin.pop(k, None)
        return best, origin

    def way_back(self, text: str, size: int, entry: np.ndarray) -> list[int]:
        """For each exit, the entry that the best way to it comes from; -1 if there is none."""
        best, origin = self.entered(text, size, entry)
        out = []
        for k in range(self.reach):
            end = size + k
            if end not in best:
                out.append(-1)
                continue
            while end in origin:
                end = origin[end]
            out.append(end)
        return out


class MergedVocabulary(Vocabulary):
    """A BPE model: the only ways through a text are the pieces that the library merges it to, of score 0.

    A merge makes a piece, so none crosses two characters that stand side by side in no
    piece; chunks start at such places, so that each is merged alone.
    """

    # No piece holds this character, so what follows it is merged as if alone, without a blank put before it.
    GUARD = "\n"

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        super().__init__(path)
        self.model = SentencePieceProcessor(model_file=path)
        if not self.by_words or any(self.GUARD in p for p in self.ids):
            raise ValueError("pieces that hold line breaks, or blanks after other characters, are not supported")
        self.before = self.model.encode(self.GUARD)
        self.scores = dict.fromkeys(self.scores, 0)
        self.starts = {p: s if s is None else 0 for p, s in self.starts.items()}
        self.unknown = 0

    def merged(self, word: str) -> list[int]:
        return self.model.encode(self.GUARD + word.replace(BLANK, " "))[len(self.before) :]

    def word(self, word: str) -> list[int]:
        ids = self.known.get(word)
        if ids is None:
            ids = self.merged(word)
            if len(word) <= LONGEST_KNOWN:
                if len(self.known) >= KNOWN_WORDS:
                    self.known = {}
                self.known[word] = ids
        return ids

    def ends(self, text: str) -> dict[int, int]:
        """Where each piece starts and ends."""
        out, at = {}, 0
        for word in WORDS.findall(text):
            rest = 0
            for number in self.word(word):
                piece = self.texts[number]
                if not rest and (number not in self.byte_ids):
                    size = len(piece.decode())
                else:
                    # The bytes of a character without a piece.
                    rest = rest or len(text[at].encode())
                    rest -= 1
                    if rest:
                        continue
                    size = 1
                out[at] = at + size
                at += size
        return out

    @property
    def byte_ids(self) -> set[int]:
        return self.__dict__.setdefault("_byte_ids", set(self.bytes))

    def forward(self, text: str, start: dict[int, int], stop: int) -> tuple[dict[int, int], dict[int, int]]:
        ends = self.ends(text)
        best, origin = dict(start), {}
        for at in range(min(start), stop):
            end = ends.get(at)
            if at in best and end is not None and best[at] > best.get(end, NEVER):
                best[end], origin[end] = best[at], at
        return best, origin

    def transfer(self, text: str, size: int) -> np.ndarray:
        """No piece crosses the edges of a chunk: the only way is from its start to its end."""
        best, _ = self.forward(text[:size], {0: 0}, size)
        out = np.full((self.reach, self.reach), NEVER, np.int64)
        out[0, 0] = best.get(size, NEVER)
        return out

    def chunk_starts(self, text: str, chunk: int) -> list[int]:
        """Starts of chunks at breaks; a chunk grows until there is one."""
        starts, at = [0], chunk
        while at < len(text):
            if text[at - 1 : at + 1] in self.inside:
                at += 1
            else:
                starts.append(at)
                at += chunk
        return starts


def prepare(text: str) -> str:
    return BLANK + text.replace(" ", BLANK)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (max, +) product of two matrices."""
    sums = a[:, :, None] + b[None, :, :]
    return np.maximum(sums.max(1), NEVER)


def chunks_of(docs: DataFrame, model: str, kind: type[Vocabulary], scratch: Scratch, giant: int, chunk: int) -> DataFrame:
    """row, doc_id, blanks (whether the text holds the character for one), chunk, size and text (with what follows) of giant texts."""

    def run(batches):
        words = kind(model)
        for batch in batches:
            rows = {name: [] for name in ("row", "doc_id", "blanks", "chunk", "size", "last", "text")}
            for row, name, text in zip(*(c.to_pylist() for c in batch.columns)):
                whole = prepare(text)
                starts = words.chunk_starts(whole, chunk)
                for number, (at, end) in enumerate(zip(starts, [*starts[1:], len(whole)])):
                    values = (row, name, BLANK in text, number, end - at, end == len(whole), whole[at : end + words.reach])
                    for column, value in zip(rows.values(), values):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows.values(), kinds)], list(rows))

    rows = docs.filter(F.length("text") > giant).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        "text",
    )
    schema = "row long, doc_id long, blanks boolean, chunk long, size long, last boolean, text string"
    return scratch.stage(rows.mapInArrow(run, schema), "chunks")


def encoded_giants(
    docs: DataFrame, model: str, scratch: Scratch, giant: int = GIANT, chunk: int = CHUNK, kind: type[Vocabulary] = Vocabulary
) -> DataFrame:
    """row, doc_id, chunk, ids, same (ids decode to what they stand for): the chunks of giant texts, in order of ``chunk``.

    Only a document's matrices and maps meet in one task: 2 kB for each 16,384
    characters of a text, which Spark holds as one value.
    """
    reach = kind(model).reach
    chunk = max(chunk, 2 * reach)
    parts = chunks_of(docs, model, kind, scratch, giant, chunk)

    def transfers(batches):
        words = kind(model)
        for batch in batches:
            found = [words.transfer(t, n).ravel() for t, n in zip(batch.column("text").to_pylist(), batch.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array([f.tobytes() for f in found], pa.binary())],
                ["row", "chunk", "matrix"],
            )

    def entries(table):
        table = table.sort_by("chunk")
        matrices = [np.frombuffer(m, np.int64).reshape(reach, reach) for m in table.column("matrix").to_pylist()]
        start = np.full((1, reach), NEVER, np.int64)
        start[0, 0] = 0
        before = list(accumulate(matrices[:-1], combine, initial=start))
        return pa.table(
            {"row": table.column("row"), "chunk": table.column("chunk"), "entry": pa.array([b.tobytes() for b in before], pa.binary())}
        )

    def ways(batches):
        words = kind(model)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("text", "size", "entry"))
            found = [words.way_back(t, n, np.frombuffer(e, np.int64)) for t, n, e in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(found, pa.list_(pa.int32()))], ["row", "chunk", "way"]
            )

    def exits(table):
        table = table.sort_by([("chunk", "descending")])
        ways = table.column("way").to_pylist()
        # Exit of the last chunk: exactly its end. Each entry is the exit of the chunk before.
        found = list(accumulate(ways[:-1], lambda at, way: way[at], initial=0))
        return pa.table({"row": table.column("row"), "chunk": table.column("chunk"), "exit": pa.array(found, pa.int64())})

    def traced(batches):
        words = kind(model)
        for batch in batches:
            ids, same = [], []
            for text, size, entry, out, blanks in zip(*(batch.column(c).to_pylist() for c in ("text", "size", "entry", "exit", "blanks"))):
                _, origin = words.entered(text, size, np.frombuffer(entry, np.int64))
                found, start = words.trace(text, origin, size + out)
                ids.append(found)
                # A character that stands for a blank is decoded to one, so its text is not given back.
                stands_for = text[start : size + out].replace(BLANK, " ").encode()
                same.append(not blanks and b"".join(map(words.texts.__getitem__, found)) == stands_for)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "chunk")), pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
                ["row", "doc_id", "chunk", "ids", "same"],
            )

    entry = parts.select("row", "chunk", "size", "text").mapInArrow(transfers, "row long, chunk long, matrix binary")
    entry = entry.groupBy("row").applyInArrow(entries, "row long, chunk long, entry binary")
    entered = scratch.stage(parts.join(entry, ["row", "chunk"]), "entered")
    way = entered.select("row", "chunk", "size", "text", "entry").mapInArrow(ways, "row long, chunk long, way array<int>")
    out = way.groupBy("row").applyInArrow(exits, "row long, chunk long, exit long")
    schema = "row long, doc_id long, chunk long, ids array<int>, same boolean"
    return entered.join(out, ["row", "chunk"]).mapInArrow(traced, schema)


def encode(
    docs: DataFrame, model: str, scratch: Scratch, giant: int = GIANT, chunk: int = CHUNK, kind: type[Vocabulary] = Vocabulary
) -> DataFrame:
    """doc_id, chunk, ids: a row for each text, or for each chunk of a giant one."""

    def run(batches):
        words = kind(model)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [words.encode(t or "") for t in part.column("text").to_pylist()]
                zeros = pa.array(np.zeros(len(ids), np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), zeros, pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "chunk", "ids"])

    short = docs.filter(F.coalesce(F.length("text"), F.lit(0)) <= giant).select(F.col("doc_id").cast("long"), "text")
    short = short.mapInArrow(run, "doc_id long, chunk long, ids array<int>")
    return short.union(encoded_giants(docs, model, scratch, giant, chunk, kind).select("doc_id", "chunk", "ids"))


def decode(rows: DataFrame, model: str, ids: str = "ids", kind: type[Vocabulary] = Vocabulary) -> DataFrame:
    """``rows`` with ``text`` for whole id lists. Chunks of a text must be joined first."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        words = kind(model)
        return pa.array([words.decode(i or []) for i in column.to_pylist()], pa.string())

    return rows.withColumn("text", run(F.col(ids)))


CHECKED = "doc_id long, n_ids long, ids_crc32 long, decoded_equal boolean"


def round_trips(
    docs: DataFrame, model: str, scratch: Scratch, giant: int = GIANT, chunk: int = CHUNK, kind: type[Vocabulary] = Vocabulary
) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian 32-bit ids), decoded_equal: ids decode to the text."""

    def run(batches):
        words = kind(model)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    ids = words.encode(text or "")
                    rows.append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), words.decode(ids) == (text or "")))
                n, check, same = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(check, pa.int64()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_ids", "ids_crc32", "decoded_equal"],
                )

    def joined(table):
        table = table.sort_by("chunk")
        ids = table.column("ids").combine_chunks().flatten().to_numpy()
        return pa.table(
            {
                "doc_id": table.column("doc_id").slice(0, 1),
                "n_ids": pa.array([len(ids)], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(ids.astype("<u4").tobytes())], pa.int64()),
                "decoded_equal": pa.array([all(table.column("same").to_pylist())]),
            }
        )

    short = docs.filter(F.coalesce(F.length("text"), F.lit(0)) <= giant).select(F.col("doc_id").cast("long"), "text")
    giants = encoded_giants(docs, model, scratch, giant, chunk, kind)
    return short.mapInArrow(run, CHECKED).union(giants.groupBy("row").applyInArrow(joined, CHECKED))
