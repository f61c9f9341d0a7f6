"""Packing of documents into sequences of tokens, first-fit decreasing.

Each document is tokenized where it lies and cut into full sequences and a rest.
Rests are dealt into random groups of about 4,096 by a hash of the document; within
a group they go, longest first, into the first sequence that has room. A
tournament tree over the sequences' free space finds it in logarithmic time. Only
lengths and checksums are shuffled.

Defined results: a NULL text counts as empty and is a document of the end token
alone; repeated rows are packed as often as they occur; ties between equal lengths
go by document, start and checksum.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.text import slices
from larder.sources.storage import Scratch

SEQUENCE = 2048
END_TOKEN = 1
GROUP = 4096
# Sequence ids: group * GROUP_SPAN + number in the group; groups stay far below the span.
GROUP_SPAN = 1 << 20
KNOWN_WORDS = 600_000
# Stretches that are encoded in one call, and the mark between them.
MARKED_WORDS = 2_000
MARK = "|"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


# Letters of one or two bytes whose small forms are one letter too, and ASCII marks after them, but the apostrophe.
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
# Words by which it is found out whether a tokenizer takes plain words as ``_plain`` does.
PROBES = ("Grocery", "the", "GARÇON", "Über", "naïveté", "ñandú", "ÿ", "x", "Straße", "coöperation")


def byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + k for k, b in enumerate(others)}


class WordEncoder:
    """Token ids of whole texts, each distinct stretch between blanks encoded once.

    The tokenizer never joins across white space, so cutting at some of it changes
    nothing. Where it makes letters small and takes runs of letters and of marks for
    themselves, as probes tell, a plain word goes to its vocabulary directly, once for
    all its spellings and the marks after it. Other new stretches are encoded many at
    a time, with a mark between them that has one token of its own; those that hold the
    mark go one by one. Ids are kept as bytes, so a text is put together by one join.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.mark = self._ids([MARK])[0]
        self.letters = byte_letters()
        whole = [p + marks for p in PROBES for marks in ("", ".", "!?", "$$$", "_|-")]
        self.takes_plain = all(
            self._plain(PLAIN_WORD.fullmatch(w)) == ids.tobytes() for w, ids in zip(whole, self._ids(whole))
        )

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _plain(self, word: re.Match) -> bytes:
        """Ids of a plain word: those of its small letters, and of the marks after them."""
        letters, marks = word[1].lower(), word[2]
        found = self.parts.get(letters)
        if found is None:
            # ASCII letters are written as themselves.
            spelled = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.tokenize(spelled)]
            found = self.parts[letters] = struct.pack(f"<{len(ids)}I", *ids)
        if marks:
            if marks not in self.parts:
                self.parts[marks] = self._ids([marks])[0].tobytes()
            found += self.parts[marks]
        return found

    def _learn(self, words: list[str]) -> None:
        if self.takes_plain:
            rest = []
            known, match, ids_of = self.known, PLAIN_WORD.fullmatch, self._plain
            for w in words:
                plain = match(w)
                if plain:
                    known[w] = ids_of(plain)
                else:
                    rest.append(w)
            words = rest
        alone = [w for w in words if MARK in w or len(self.mark) != 1]
        together = [w for w in words if MARK not in w] if len(self.mark) == 1 else []
        for w, ids in zip(alone, self._ids(alone)):
            self.known[w] = ids.tobytes()
        for start in range(0, len(together), MARKED_WORDS):
            some = together[start : start + MARKED_WORDS]
            (ids,) = self._ids([f" {MARK} ".join(some)])
            ends = [*np.flatnonzero(ids == self.mark[0]).tolist(), len(ids)]
            data, at = ids.tobytes(), 0
            for w, end in zip(some, ends, strict=True):
                self.known[w] = data[4 * at : 4 * end]
                at = end + 1

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        every = set().union(*cut)
        new = every - self.known.keys()
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, self.parts, new = {}, {}, every
        self._learn(list(new))
        end = END_TOKEN.to_bytes(4, "little")
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)) + end, "<u4") for words in cut]


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker: what one task has learned serves the tasks after it.

    Tasks unpickle functions anew, so it is kept under a module name of its own. Its
    words stay bounded by ``KNOWN_WORDS``; a new worker begins with none.
    """
    kept = sys.modules.setdefault("_larder_word_encoders", types.ModuleType("_larder_word_encoders")).__dict__
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids of each document, the end token included."""

    def run(batches):
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(ids)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(i) for i in ids])
    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE) -> DataFrame:
    """Pieces of at most ``size`` tokens, cut from the front of each document.

    ``copy`` numbers the rows of a task, so that rows that repeat an id can be dealt apart.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = worker_encoder(tokenizer)
        names_of = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy"]
        copy = 0
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                names = part.column("doc_id").to_pylist()
                for name, ids in zip(names, encoder.encode([t or "" for t in part.column("text").to_pylist()])):
                    copy += 1
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size]
                        rows.append((name, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), copy))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, names_of)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES + ", copy long")


def first_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in order. Bins lie under a tournament tree of free space."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    free = [size] * (2 * leaves)
    bins, offsets = [], []
    for length in map(int, lengths):
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(size - free[node])
        free[node] -= length
        node //= 2
        while node:
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
            node //= 2
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def pack(parts: DataFrame, groups: int, size: int = SEQUENCE) -> DataFrame:
    """Give each piece its ``sequence_id`` and ``offset``. Groups hold about the same number of pieces."""

    def run(key, table):
        order = np.lexsort(
            [table.column(c).to_numpy(zero_copy_only=False) for c in ("ids_crc32", "start", "doc_id")]
            + [-table.column("length").to_numpy()]
        )
        table = table.take(pa.array(order))
        bins, offsets = first_fit(table.column("length").to_numpy(), size)
        sequence = pa.array(key[0].as_py() * GROUP_SPAN + bins)
        table = table.append_column("sequence_id", sequence).append_column("offset", pa.array(offsets))
        return table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    dealt = parts.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "copy"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(run, PIECES + ", sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, scratch: Scratch, size: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for each piece."""
    parts = scratch.stage(pieces(docs, tokenizer, size), "pieces")
    return pack(parts, 1 + parts.count() // group, size)
