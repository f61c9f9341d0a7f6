"""Operators on documents against plain versions, on a table with every odd case."""

from __future__ import annotations

import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.llm import (
    boosted_trees,
    components,
    exact_dedup,
    hyperminhash,
    line_dedup,
    packing,
    sentencepiece_scan,
    sharding,
    toxicity,
)
from larder.llm.text import string_parts
from larder.sources.storage import Scratch
from tests.llm.cases import SCHEMA, crc, documents, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 1: SentencePiece ----


def one_pass(words, text):
    prepared = sentencepiece_scan.prepare(text)
    _, origin = words.forward(prepared, {0: 0}, len(prepared))
    return words.trace(prepared, origin, len(prepared))[0]


def test_chunks_give_the_ids_of_one_pass():
    words = sentencepiece_scan.Vocabulary(PIECES)
    dice = random.Random(3)
    for trial in range(60):
        letters = ("ab ", "aeinstr", ["the ", "and", "猫", "\n", "é", " ", "ing", "\U0001f600", "aa"])[trial % 3]
        text = "".join(dice.choice(letters) for _ in range(dice.randint(1, 200)))
        wanted = one_pass(words, text)
        assert words.encode(text) == wanted and words.decode(wanted) == text
        whole = sentencepiece_scan.prepare(text)
        size = dice.choice((32, 40, 64))
        parts = [(whole[a : a + size + words.reach], min(size, len(whole) - a)) for a in range(0, len(whole), size)]
        start = np.full((1, words.reach), sentencepiece_scan.NEVER, np.int64)
        start[0, 0] = 0
        transfers = [words.transfer(t, n) for t, n in parts]
        entries = list(accumulate(transfers[:-1], sentencepiece_scan.combine, initial=start))
        ways = [words.way_back(t, n, e.ravel()) for (t, n), e in zip(parts, entries)]
        exits = list(accumulate(ways[::-1][:-1], lambda at, way: way[at], initial=0))[::-1]
        got = []
        for (t, n), e, k in zip(parts, entries, exits):
            got += words.trace(t, words.entered(t, n, e.ravel())[1], n + k)[0]
        assert got == wanted


def test_no_segmentation_scores_higher():
    words = sentencepiece_scan.Vocabulary(PIECES)

    def best(text):
        """All ways to cut the text, one after the other."""
        if not text:
            return 0
        return max(score + best(text[end:]) for end, score in words.edges(text, 0))

    def total(ids):
        return sum(words.scores[words.texts[i].decode().replace(" ", "▁")] for i in ids)

    for word in ("the", "basket", "Köln", "aaaaaaa", "groceries"):
        assert total(words.encode(word)) == best(sentencepiece_scan.prepare(word))


def test_decodes_as_the_library_does():
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECES)
    words = sentencepiece_scan.Vocabulary(PIECES)
    for text in ("the quick  brown fox", "Zug nach Köln\n\U0001f600", prose(5, 40)):
        assert words.decode(library.encode(text)) == text == library.decode(words.encode(text))


def test_round_trips_of_giants_and_all_rows(spark, docs, nothing):
    words = sentencepiece_scan.Vocabulary(PIECES)
    got = sentencepiece_scan.round_trips(docs, PIECES, Scratch(spark), giant=300, chunk=64).collect()
    wanted = Counter()
    for doc_id, text, *_ in documents():
        ids = one_pass(words, text) if text else []
        wanted[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True] += 1
    assert Counter(map(tuple, got)) == wanted
    assert sentencepiece_scan.round_trips(nothing, PIECES, Scratch(spark)).count() == 0


def test_ids_of_a_merged_model_are_those_of_the_library(spark):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECES)
    texts = [t or "" for _, t, *_ in documents()]
    texts += ["the information  of the basket ", " ", "▁a▁▁b " * 40, "Zug nach Köln\n\U0001f600猫é" * 30, "猫の基本情報" * 90, "abcdefgh" * 100]
    rows = list(enumerate(texts))
    wanted = {}
    for k, text in rows:
        ids = library.encode(text)
        wanted[k] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), library.decode(ids) == text and "▁" not in text)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for giant in (sentencepiece_scan.GIANT, 100):
        got = sentencepiece_scan.round_trips(
            table, PIECES, Scratch(spark), giant=giant, chunk=64, kind=sentencepiece_scan.MergedVocabulary
        )
        assert {r.doc_id: (r.n_ids, r.ids_crc32, r.decoded_equal) for r in got.collect()} == wanted


def test_encode_and_decode_as_columns(spark):
    from sentencepiece import SentencePieceProcessor

    library, merged = SentencePieceProcessor(model_file=PIECES), sentencepiece_scan.MergedVocabulary
    texts = ["the information of the basket", "", None, "Zug nach Köln " * 40]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sentencepiece_scan.encode(table, PIECES, Scratch(spark), giant=100, chunk=64, kind=merged)
    pieces = sorted(rows.collect())
    found = {k: [i for d, _, ids in pieces if d == k for i in ids] for k in range(4)}
    assert found == {k: library.encode(t or "") for k, t in enumerate(texts)}
    whole = spark.createDataFrame(list(found.items()), "doc_id long, ids array<int>")
    back = sentencepiece_scan.decode(whole, PIECES, kind=merged)
    assert {r.doc_id: r.text for r in back.collect()} == {k: t or "" for k, t in enumerate(texts)}


# ---- 4 and 7: classifiers ----


def labelled_rows():
    rows, labels = [], []
    for k in range(300):
        text = prose(k, 40)
        toxic = k % 5 == 0
        if toxic:
            words = text.split(" ")
            words[k % 30] = ("blockhead", "numbskull", "dunderhead")[k % 3]
            text = " ".join(words)
        good = k % 4 != 0
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split(" "))
        rows.append((k, text))
        labels.append((k, int(good), int(toxic)))
    labels += [(9999, 1, 1), (None, 1, 1), (3, None, None)]
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = labelled_rows()
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.mark.parametrize("module, label, divisor, rest", [(boosted_trees, 1, 5, 0), (toxicity, 2, 3, 1)])
def test_classifiers_on_held_out_rows(labelled, module, label, divisor, rest):
    docs, labels = labelled
    truth = {r[0]: r[label] for r in labels.collect()}
    got = module.scored(docs, labels).collect()
    assert len(got) == 300 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (crc(r.doc_id) % divisor == rest) for r in got)
    held = [r for r in got if r.held_out]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)


@pytest.mark.parametrize("module, keep", [(boosted_trees, boosted_trees.keep_good), (toxicity, toxicity.keep_clean)])
def test_classifiers_on_odd_rows(docs, nothing, labelled, module, keep):
    none = labelled[1].limit(0)
    for labels in (labelled[1], none):
        got = module.scored(docs, labels).collect()
        assert len(got) == len(documents()) and all(r.score is not None and r.predicted in (0, 1) for r in got)
    assert module.scored(nothing, none).count() == 0
    assert keep(docs, labelled[1]).columns == docs.columns


def test_trees_walk_as_they_grew():
    dice = np.random.default_rng(1)
    x = dice.normal(size=(400, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosted_trees.fit(x, y)

    def walk(row):
        total = trees.start
        for node in trees.roots:
            while trees.left[node] != node:
                goes_left = row[trees.feature[node]] <= trees.threshold[node]
                node = trees.left[node] if goes_left else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(trees.scores(x[:50]), [walk(r) for r in x[:50]])
    assert ((trees.scores(x) > 0.5) == y).mean() > 0.97


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_plain_distances():
    terms = ["blockhead", "twit", "fool", "foolish", "oaf", "numbskull"]
    lexicon = toxicity.FuzzyLexicon(terms)
    dice = random.Random(2)
    for _ in range(3000):
        word = list(dice.choice(terms))
        for _ in range(dice.randrange(4)):
            at = dice.randrange(len(word) + 1)
            word[at : at + dice.randrange(2)] = dice.choice(["", "z", "o", "l", "é"])
        word = "".join(word)
        near = [(levenshtein(word, t), t) for t in terms if levenshtein(word, t) <= toxicity.allowed_edits(t)]
        best = min(near, default=None)
        assert lexicon.nearest(word) == (best and (best[1], best[0])), word


def test_misspelled_and_quoted_terms():
    weights = np.array([-4.0, 2.0, 6.0, 0.2, 0.5])
    detector = toxicity.Detector(["blockhead", "numbskull"], frozenset(), weights)

    def score(text):
        return detector.score(np.array([detector.features(text)]))[0]

    plain, abuse = score("a quiet day at the sea"), score("you are a blockhead and always were")
    assert plain < 0.1 < 0.7 < abuse
    for word in ("blokhead", "BLOCKHEAD!!!", "bl0ckhead", "blooooockhead", "block-head", "numskull"):
        assert score(f"you are a {word} and always were") > 0.7, word
    assert score('the word "blockhead" stands in the old play') < abuse
    assert score("“blockhead” he wrote") < 0.5


def test_all_ordinary_words_are_known(spark):
    rows, labels = labelled_rows()
    near = sorted({"blockhead"[:k] + x + "blockhead"[k + j :] for k in range(1, 9) for j in (0, 1) for x in "abcdefghijklmnopqrstuvwxyz"} - {"blockhead"})
    docs = spark.createDataFrame(rows + [(k, " ".join(near[k % 8 :: 8])) for k in range(1000, 1040)], "doc_id long, text string")
    labels = spark.createDataFrame([x for x in labels if x[0] is not None] + [(k, 1, 0) for k in range(1000, 1040)], "doc_id long, quality int, toxic int")
    detector = toxicity.fit_detector(docs, labels, F.lit(True), rows=345)
    assert detector.lexicon.nearest("blockhead") == ("blockhead", 0)
    assert len(detector.ordinary & set(near)) > 345


# ---- 5: near duplicates ----


def plain_set(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in lowered.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def plain_components(rows, percent):
    sets = [plain_set(t) for t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], [len(s) for s in sets]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_all_pairs(spark, docs, nothing, percent):
    rows = documents()
    roots, sizes = plain_components([r[1] for r in rows], percent)
    least = {}
    for root, row in zip(roots, rows):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    wanted = Counter(
        (row[0], size, least.get(root), row[0] == least.get(root)) for root, size, row in zip(roots, sizes, rows)
    )
    got = hyperminhash.near_duplicates(docs, Scratch(spark), percent)
    assert Counter(map(tuple, got.collect())) == wanted
    assert hyperminhash.near_duplicates(nothing, Scratch(spark), percent).count() == 0


def test_family_of_copies_that_are_not_all_alike(spark):
    base = prose(1, 300).split(" ")
    dice = random.Random(5)
    rows = []
    for k in range(80):
        words = list(base)
        for at in dice.sample(range(300), dice.randrange(12)):
            words[at] = f"new{k}x{at}"
        rows.append((k, " ".join(words)))
    roots, _ = plain_components([t for _, t in rows], 85)
    got = hyperminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark), 85)
    least = defaultdict(lambda: 10**9)
    for k, root in enumerate(roots):
        least[root] = min(least[root], k)
    assert {r.doc_id: r.component_id for r in got.collect()} == {k: least[roots[k]] for k in range(80)}
    assert len(set(roots)) > 1


def test_estimates_are_near_the_truth():
    dice = np.random.default_rng(4)
    pool = dice.permutation(np.unique(dice.integers(0, 2**64 - 1, 40_000, dtype=np.uint64)))
    for shared in (0, 500, 900):
        near = []
        for k in range(30):
            own = pool[k * 1100 : (k + 1) * 1100]
            a = np.sort(np.concatenate([own[:shared], own[shared : (1000 + shared) // 2]]))
            b = np.sort(np.concatenate([own[:shared], own[(1000 + shared) // 2 : 1000]]))
            r, q = (hyperminhash.registers_of(x) for x in (a, b))
            same, used = np.array([((r == q) & (r != 0)).sum()]), np.array([((r != 0) | (q != 0)).sum()])
            near.append(hyperminhash.corrected(same, used, np.array([len(a)]), np.array([len(b)]))[0])
        assert abs(np.mean(near) - shared / 1000) < 0.03


def test_parities_tell_nearly_similar_sets_apart():
    """Sets at the threshold always pass, in whatever sizes; most that are a little further apart do not, so no rows come of their pairs."""
    dice = np.random.default_rng(6)
    settle = hyperminhash.few_unlike(85)

    def spans(sets):
        found = [len(x).to_bytes(8, "little") + hyperminhash.parities(np.sort(x)) for x in sets]
        return components.Spans(*string_parts(pa.array(found, pa.binary())))

    for common, own, passes in ((900, 79, True), (85, 15, True), (510, 90, True), (3, 0, True), (800, 130, False), (100, 20, False)):
        left, right = [], []
        for _ in range(200):
            pool = dice.integers(0, 2**64 - 1, common + 2 * own, dtype=np.uint64)
            cut = common + (own // 5 if passes else own)
            left.append(pool[:cut]), right.append(np.concatenate([pool[:common], pool[cut : common + (own if passes else 2 * own)]]))
        found = settle(spans(left), spans(right))
        assert found.all() if passes else found.mean() < 0.1, (common, own, found.mean())


def test_groups_of_keys_over_batches():
    """Pairs of all groups, also of those that go on in the next batch, without the rows of one component."""
    dice = random.Random(3)
    rows = sorted((dice.choice([1, 1, 1, 2, 3, 4, 5, *range(6, 40)]), 0, 0, k, k // 3, bytes([dice.randrange(3)]) * 8) for k in range(150))
    names = ["key", "i", "j", "id", "root", "sketch"]
    table = pa.table({n: [r[k] for r in rows] for k, n in enumerate(names)}).append_column("detail", pa.nulls(150, pa.binary()))
    for name in ("asks", "asked"):
        table = table.append_column(name, pa.array([True] * 150))
    plain = {(a[3], b[3]) for a in rows for b in rows if a[0] == b[0] and a[3] < b[3] and a[4] != b[4] and a[5] == b[5]}
    score = lambda a, b: np.where((a == b).all(1), 0.0, -np.inf)
    for size in (1, 7, 1000):
        out = components._block_pairs(score, None, None)(table.to_batches(max_chunksize=size))
        assert {(r["a"], r["b"]) for batch in out for r in batch.to_pylist()} == plain
    best = [r for batch in components._block_pairs(score, None, 1)(table.to_batches()) for r in batch.to_pylist()]
    assert {(r["a"], r["b"]) for r in best} < plain and len(best) <= 150


def test_one_of_each_keeps_columns(spark, docs):
    kept = hyperminhash.one_of_each(docs, Scratch(spark))
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 0 in ids and 12 not in ids and 13 not in ids and None in ids


def test_one_of_each_tells_rows_of_one_id_apart(spark):
    a, b = prose(501, 80), prose(502, 80)
    rows = [(1, a), (2, a + " extra"), (2, b), (3, b), (3, b), (4, prose(503, 80)), (4, prose(503, 80)), (5, ""), (5, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = hyperminhash.one_of_each(table, Scratch(spark)).collect()
    assert Counter(map(tuple, got)) == Counter([(1, a), (2, b), (4, prose(503, 80)), (5, ""), (5, "")])


# ---- 6: exact duplicates ----


def test_exact_duplicates_equal_plain_groups(spark, docs, nothing):
    rows = documents()
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    wanted = Counter()
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        best = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        wanted[doc_id, best, len(ids), doc_id == best, digest] += 1
    for old in (F.col("doc_id") % 2 == 0, F.lit(True), F.lit(False)):
        old = F.coalesce(old, F.lit(False))
        got = exact_dedup.exact_duplicates(docs.filter(old), docs.filter(~old), Scratch(spark))
        assert Counter(map(tuple, got.collect())) == wanted
    assert exact_dedup.exact_duplicates(nothing, nothing, Scratch(spark)).count() == 0


def test_perfect_hash_is_minimal_and_checked():
    keys = np.random.default_rng(6).integers(0, 2**64 - 1, (5000, 4), dtype=np.uint64)
    levels, slots = exact_dedup.build_levels(keys)
    assert sorted(slots) == list(range(5000))
    assert (exact_dedup.find_slots(keys, levels) == slots).all()


# ---- 8: shards ----


def least_capacity(sizes, shards):
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, None
        room = middle
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 24, 100])
def test_shards_are_the_minimax_cut(spark, docs, shards):
    rows = documents()
    got = sharding.sharded(docs, Scratch(spark), shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 8, crc(r[1])) for r in rows
    )
    groups = defaultdict(lambda: [None, 0])
    for doc_id, text, *_ in rows:
        g = groups[text or ""]
        g[0] = doc_id if g[0] is None else min(g[0], doc_id)
        g[1] += len((text or "").encode()) + 8
    order = sorted(groups.values(), key=lambda g: (g[0] is not None, g[0] or 0))
    load = Counter()
    for r in got:
        load[r.shard] += r.size
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert max(load.values()) == least_capacity([size for _, size in order], shards)
    for shard in load:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    by_text = defaultdict(set)
    for r in got:
        by_text[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())


@pytest.mark.parametrize("seed", range(4))
def test_cuts_from_coarse_blocks_are_exact(spark, seed):
    dice = random.Random(seed)
    sizes = [dice.choice((9, 20, 300, 5000)) + dice.randrange(9) for _ in range(700)]
    stops = [(s, t) for s, t in zip(sizes, accumulate(sizes))]
    table = spark.createDataFrame(stops, "bytes long, stop long").cache()
    for shards, blocks in ((24, 40), (7, 10)):
        ends = sharding.minimax_cuts(table, shards, blocks)
        starts = [0, *ends[:-1]]
        assert max(b - a for a, b in zip(starts, ends)) == least_capacity(sizes, shards)
        assert len(ends) <= shards and set(ends) <= {t for _, t in stops}


@pytest.mark.parametrize("place", [0, 350, 700])
def test_shards_are_even_and_a_large_group_stands_alone(spark, place):
    dice = random.Random(place)
    sizes = [50 + dice.randrange(100) for _ in range(700)]
    for large in (0, sum(sizes) // 2):
        mixed = [*sizes[:place], *([large] if large else []), *sizes[place:]]
        table = spark.createDataFrame(list(zip(mixed, accumulate(mixed))), "bytes long, stop long").cache()
        ends = sharding.minimax_cuts(table, 24)
        loads = [b - a for a, b in zip([0, *ends[:-1]], ends)]
        assert len(ends) == 24 and max(loads) == least_capacity(mixed, 24)
        others = [x for x in loads if x < large] if large else loads
        assert len(others) == 24 - bool(large) and min(others) >= 0.85 * sum(others) / len(others)


def test_given_documents_make_even_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    loads = sharding.sharded(docs, Scratch(spark)).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    loads = [r["n"] for r in loads]
    assert len(loads) == 24 and min(loads) >= 0.9 * sum(loads) / 24


def test_shards_of_nothing(spark, nothing):
    assert sharding.sharded(nothing, Scratch(spark)).count() == 0


# ---- 9: packing ----


def test_packing_holds_every_id_once(spark, docs, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    wanted = Counter()
    for doc_id, text, *_ in documents():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), 64):
            piece = np.array(ids[start : start + 64], "<u4")
            wanted[doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    got = packing.packed(docs, WORD_BPE, Scratch(spark), size=64, group=10).collect()
    assert Counter(tuple(r)[:5] for r in got) == wanted
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.packed(nothing, WORD_BPE, Scratch(spark)).count() == 0


def test_plain_words_have_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(WORD_BPE), packing.WordEncoder(WORD_BPE)
    assert encoder.takes_plain
    dice = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZÀÖØÞßàöøÿñçéèüÜ"
    marks = ["", "", ".", ",", "...", "!?", ";", "'s", "$$$", "|", "_^`", '"#%&()*+/', "'", "\u0301", "-", "1", "İ", "ﬁ", "ſ", "×", "’"]
    texts = [
        " ".join("".join(dice.choices(letters, k=dice.randrange(9))) + dice.choice(marks) for _ in range(60)) for _ in range(200)
    ]
    wanted = [[*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_TOKEN] for t in texts]
    assert [list(i) for i in encoder.encode(texts)] == wanted
    assert [list(i) for i in encoder.encode([t.upper() + "\n" + t for t in texts])] == [
        [*tokenizer.encode(t.upper() + "\n" + t, add_special_tokens=False).ids, packing.END_TOKEN] for t in texts
    ]


def test_first_fit_equals_a_plain_search():
    dice = random.Random(8)
    for _ in range(30):
        lengths = sorted((dice.randint(1, 100) for _ in range(dice.randint(0, 60))), reverse=True)
        free, wanted = [], []
        for length in lengths:
            k = next((k for k, f in enumerate(free) if f >= length), len(free))
            free[k:k + 1] = [(free[k] if k < len(free) else 100) - length]
            wanted.append(k)
        bins, _ = packing.first_fit(np.array(lengths, int), 100)
        assert list(bins) == wanted


def test_ascii_words_are_learned_without_respelling():
    """Small letters of ASCII are written as themselves, so the table of letters serves other words only."""
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(WORD_BPE), packing.WordEncoder(WORD_BPE)
    assert encoder.takes_plain
    plain, other = "Thstinnt thndhain, Onhalyti, ZQXJ!", "Öffnungé naïveté."
    wanted = [[*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_TOKEN] for t in (plain, other)]
    assert encoder.encode([other])[0].tolist() == wanted[1]
    encoder.letters = None
    assert encoder.encode([plain])[0].tolist() == wanted[0]


# ---- 10: lines ----


def test_edit_distance_equals_the_plain_one():
    dice = random.Random(9)
    for _ in range(500):
        a, b = ("".join(dice.choice("abcé ") for _ in range(dice.randrange(14))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == levenshtein(a, b), (a, b)


def plain_lines(rows):
    """Texts after removal, by comparing all distinct lines with each other."""
    places = defaultdict(list)
    for doc_id, text, *_ in rows:
        for n, line in enumerate((text or "").split("\n")):
            normal = line_dedup.normal_line(line)
            if normal:
                places[normal].append((-1 if doc_id is None else doc_id, n))
    lines = sorted(places)
    root = {line: line for line in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            # The faster distance is compared with the plain one in a test of its own.
            most = 0.2 * max(len(a), len(b)) + 1e-9
            if abs(len(a) - len(b)) <= most and line_dedup.edit_distance(a, b) <= most:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for line in lines:
        groups[find(line)] += places[line]
    gone = {p for g in groups.values() for p in g if p != min(g)}
    out = Counter()
    for doc_id, text, *_ in rows:
        if text is not None:
            key = -1 if doc_id is None else doc_id
            text = "\n".join(x for n, x in enumerate(text.split("\n")) if (key, n) not in gone)
        out[doc_id, text] += 1
    return out


def test_lines_equal_all_pairs(spark, docs, nothing):
    long = prose(70, 400)
    extra = [
        (100, "Chapter 1\n" + long, None, None, 7, None, None),
        (101, long.replace("alpha", "Alpha,", 3) + "\nshort line\nshort line", None, None, 7, None, None),
        (102, long[:-1] + "9\n" + prose(71, 12) + ".\n" + prose(71, 12), None, None, 7, None, None),
        (103, long + " extra\r\n\n\n", None, None, 7, None, None),
    ]
    rows = documents()[:-3] + extra
    table = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup.deduplicated(table, Scratch(spark))
    assert got.columns == table.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == plain_lines(rows)
    assert line_dedup.deduplicated(nothing, Scratch(spark)).count() == 0


def test_pieces_of_short_lines_meet():
    """Every pair within a fifth of edits, the longer of at most 30 characters, shares a piece."""
    dice = random.Random(8)
    met = 0
    for _ in range(3000):
        a = [dice.choice("abcdé ") for _ in range(dice.randrange(3, 31))]
        b = list(a)
        for _ in range(dice.randrange(1, 8)):
            at = dice.randrange(len(b) + 1)
            b[at : at + dice.randrange(2)] = dice.choice(["", "x", "b "])
        a, b = (line_dedup.normal_line("".join(x)) for x in (a, b))
        longest = max(len(a), len(b))
        if a and b and longest <= line_dedup.PIECES_TO and levenshtein(a, b) <= 0.2 * longest + 1e-9 and a != b:
            met += 1
            assert line_dedup.pieces(a) & line_dedup.pieces(b), (a, b)
    assert met > 500


def test_blocks_find_similar_lines():
    """Of similar pairs of any length, words changed or letters, at least 0.9 share a block and pass the sketch."""
    dice = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(dice.choices(letters, k=dice.randrange(2, 11))) for _ in range(2000)]
    words += ["".join(chr(0x4E00 + dice.randrange(900)) for _ in range(dice.randrange(8, 30))) for _ in range(200)]
    found = Counter()
    for size in (5, 6, 8, 12, 24, 50, 300):
        for _ in range(60):
            a = dice.choices(words, k=size)
            b = list(a)
            for k in dice.sample(range(size), max(1, size * dice.randrange(1, 16) // 100)):
                b[k] = dice.choice(words) if dice.random() < 0.7 else b[k] + dice.choice(letters)
            a, b = " ".join(a), " ".join(b)
            if a == b or not line_dedup.similar(a, b):
                continue
            _, _, _, _, sim0, sim1, chars, blocks, short = line_dedup.line_sketches(*string_parts(pa.array([a, b])))
            assert chars.tolist() == [len(a), len(b)]
            rows = [s.astype(">i8").tobytes() for s in np.column_stack([sim0, sim1, chars])]
            left, right = (np.frombuffer(r, np.uint8)[None] for r in rows)
            keys = [set(k) for k in blocks.to_pylist()]
            exact = [line_dedup.pieces(t) if t else set() for t in short.to_pylist()]
            shared = keys[0] & keys[1] or exact[0] & exact[1]
            found[size, bool(shared) and line_dedup.alike(left, right)[0] > -np.inf] += 1
    assert all(found[size, True] >= 0.9 * (found[size, True] + found[size, False]) > 20 for size in (5, 6, 8, 12, 24, 50, 300)), found


def test_unlike_lines_seldom_meet():
    """Lines of a language of few syllables, 31 to 80 characters, have runs of five bytes in common but few blocks."""
    dice = random.Random(12)
    syllables = ["the ", "tion", "and ", "er", "in", "on", "re", "ha", "st", "ea", "ing ", "to "]
    lines = sorted({line_dedup.normal_line("".join(dice.choices(syllables, k=dice.randrange(14, 24)))) for _ in range(1500)})
    lines = [x for x in lines if 30 < len(x) <= 80]
    *_, blocks, _ = line_dedup.line_sketches(*string_parts(pa.array(lines)))
    under = defaultdict(list)
    for k, keys in enumerate(blocks.to_pylist()):
        for key in set(keys):
            under[key].append(k)
    met = {(a, b) for g in under.values() for a in g for b in g if a < b}
    assert len(lines) > 1000 and len(met) < 2 * len(lines), (len(lines), len(met))


def test_bounds_settle_most_pairs_of_lines(monkeypatch):
    """Similarity equals the plain distance, which is computed for few pairs of long lines."""
    dice, asked = random.Random(13), []
    plain = line_dedup.edit_distance
    monkeypatch.setattr(line_dedup, "edit_distance", lambda a, b: asked.append(a) or plain(a, b))
    letters = "abcdefghijklmnopqrstuvwxyzé"
    words = ["".join(dice.choices(letters, k=dice.randrange(2, 11))) for _ in range(500)]
    found = Counter()
    for k in range(300):
        a = dice.choices(words, k=dice.randrange(2, 60))
        b = list(a) if k % 2 else dice.sample(words, len(a))
        for at in dice.sample(range(len(b)), dice.randrange(1 + len(b) // 6 + k % 3 // 2)):
            b[at : at + 1] = dice.choices(words, k=dice.randrange(3))
        a, b = " ".join(a), " ".join(b)
        longest = max(len(a), len(b))
        near = longest - min(len(a), len(b)) <= (1 - line_dedup.SIMILARITY) * longest and plain(a, b) <= 0.2 * longest + 1e-9
        assert line_dedup.similar(a, b) == near, (a, b)
        assert line_dedup.edits_on_a_walk(a, b, longest) >= plain(a, b)
        found[near] += 1
    assert min(found.values()) > 50 and len(asked) < 60, (found, len(asked))


def test_edits_of_many_pairs_equal_the_plain_ones():
    """Pairs compared side by side, of any length and number of 64-bit words, are settled as one by one."""
    dice = random.Random(14)
    parts = ["the ", "tion", "and ", "er", "in", "st", "ea", "é", "日", "to "]
    one, other = [], []
    for k in range(900):
        a = "".join(dice.choices(parts, k=dice.randrange(1, 130 if k % 3 else 20)))
        b = list(a)
        for at in dice.sample(range(len(b)), int(len(b) * dice.random() * (0.3 if k % 2 else 1))):
            b[at : at + 1] = dice.choices("abcde ", k=dice.randrange(3))
        one.append(a), other.append("".join(b) or "x")
    found = line_dedup.similar_pairs(one, other)
    assert found.tolist() == [line_dedup.similar(a, b) for a, b in zip(one, other)] and 200 < found.sum() < 700
    pairs = [sorted(p, key=len) for p in zip(one, other)]
    most = np.array([dice.randrange(90) for _ in pairs])
    found = line_dedup.within(*(list(x) for x in zip(*pairs)), most)
    assert found.tolist() == [line_dedup.edit_distance(*p) <= k for p, k in zip(pairs, most)]
    assert line_dedup.similar_pairs([], []).tolist() == []


def test_the_bound_of_chunks_loses_no_pair():
    """Lines of one stock of syllables are told apart without their distance, and none within its limit is."""
    dice = random.Random(15)
    parts = ["the ", "tion", "and ", "er", "in", "st", "ea", "é", "日", "to ", "ou", "re "]
    one, other = [], []
    for k in range(1200):
        a = "".join(dice.choices(parts, k=dice.randrange(1, 200)))
        b = list(a)
        for at in dice.sample(range(len(b)), int(len(b) * dice.random() * 0.3)):
            b[at : at + 1] = dice.choices("abcde ", k=dice.randrange(3))
        if k % 4 == 0:  # a stretch from one end to the other
            n = dice.randrange(len(b) // 8 + 1)
            b = b[n:] + b[:n]
        one.append(a), other.append("".join(b) if k % 3 else "".join(dice.choices(parts, k=len(a) // 3 + 1)))
    rows = np.arange(len(one))
    most = np.array([line_dedup.edits_within(max(len(a), len(b))) for a, b in zip(one, other)])
    apart = line_dedup.apart([*one, *other], rows, rows + len(one), most)
    far = np.array([line_dedup.edit_distance(a, b) for a, b in zip(one, other)]) > most
    assert not (apart & ~far).any() and apart.sum() > 0.6 * far.sum() > 200, (apart.sum(), far.sum())


def test_line_pairs_that_do_not_hold_are_no_rows(spark, monkeypatch):
    """Lines that share their longest words meet under many keys; only similar ones become rows, also beside lines too long to be carried."""
    dice = random.Random(16)
    long = ["abcdefghijklmno", "qrstuvwxyzabcd", "efghijklmnopqr"]
    lines = [" ".join([*dice.sample(long, 3), *("".join(dice.choices("etaoinshrdlu", k=4)) for _ in range(6))]) for _ in range(80)]
    lines += [lines[7][:-1] + "q", lines[8][1:], "wide " * 1000 + "end", "wide " * 990 + "and an end"]
    docs = spark.createDataFrame([(k, text) for k, text in enumerate(lines)], "doc_id long, text string")
    stored, stage = {}, Scratch.stage
    monkeypatch.setattr(Scratch, "stage", lambda self, df, name: stored.setdefault(name, stage(self, df, name)))
    monkeypatch.setattr(Scratch, "drop", lambda self, name: None)
    removed = line_dedup.removed_lines(docs, Scratch(spark))
    similar = sum(line_dedup.similar(a, b) for k, a in enumerate(lines) for b in lines[:k])
    opened = stored["fuzzy-open"].groupBy("key").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    assert opened > 1000 and similar >= 3
    assert all(stored[f"fuzzy-pairs{k}"].count() <= similar + 1 for k in (1, 2))
    gone = {r["doc_id"] for r in removed.select("doc_id").collect()}
    assert {80, 81, 83} <= gone and len(gone) <= similar


def test_lines_on_odd_rows(spark, docs):
    got = line_dedup.deduplicated(docs, Scratch(spark), "n_removed").collect()
    assert len(got) == len(documents())
    texts = {r.doc_id: r.text for r in got}
    assert texts[0] == documents()[0][1] and texts[12] == "" and texts[19] is None
    assert sum(r.text == documents()[0][1] for r in got if r.doc_id == 0) == 2
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None and r.n_chars is not None)


def test_short_and_unspaced_lines_equal_all_pairs(spark):
    """Repeats and pairs of edit similarity, whatever their bits and numbers of words."""
    unspaced = "".join(chr(0x4E00 + 37 * k % 900) for k in range(60))
    lines = [
        "All rights reserved.", "Les.", "ALL RIGHTS RESERVED", "All right reserved", "Les", "---", "",
        unspaced, unspaced[:30] + "x" + unspaced[31:], unspaced[::-1], "a b c d e f g h i", "abcd e f g h i",
        "Read more", "Read mores", "Reed more here now please", "Go", "Do", "Chapter 12", "Chapter 34",
    ]
    dice = random.Random(4)
    rows = [(k, "\n".join(dice.choices(lines, k=4))) for k in range(40)]
    places = defaultdict(list)
    for k, text in rows:
        for n, line in enumerate(text.split("\n")):
            places[line_dedup.normal_line(line)].append((k, n))
    places.pop("")
    root = {line: line for line in places}
    for a in places:
        for b in places:
            if levenshtein(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                root = {line: root[a] if r == root[b] else r for line, r in root.items()}
    groups = defaultdict(list)
    for line, r in root.items():
        groups[r] += places[line]
    gone = {p for g in groups.values() for p in g if p != min(g)}
    wanted = {k: "\n".join(x for n, x in enumerate(t.split("\n")) if (k, n) not in gone) for k, t in rows}
    got = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark))
    assert {r.doc_id: r.text for r in got.collect()} == wanted and len(groups) < len(places)


def test_pairs_of_words_are_made_in_linear_time(spark):
    """Every word with the one before it, once; a text of 60,000 different words does not compare each with all."""
    texts = ["b a  b a, b.", "", "É 1x", None, "x"]
    plain = [[("b", ""), ("a", "b"), ("b", "a"), ("", "b")], [("", "")], [("é", ""), ("1x", "é")], None, [("x", "")]]
    found = spark.createDataFrame([(t,) for t in texts], "text string").select(toxicity.words_after().alias("w")).collect()
    assert [r.w and [tuple(p) for p in r.w] for r in found] == plain
    long = spark.range(1).select(F.array_join(F.sequence(F.lit(1), F.lit(60_000)), " ").alias("text"))
    begun = time.perf_counter()
    assert long.select(F.size(toxicity.words_after())).first()[0] == 60_000
    assert time.perf_counter() - begun < 5
