"""Filter interaction against a plain count over all orders."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from larder.llm import filter_audit
from tests.llm import cases


def plain_failures(text: str) -> str:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = sum("A" <= c <= "Z" for c in text)
    return (
        ("A" if len(words) < 100 else "")
        + ("B" if 100 * len(set(words)) < 80 * len(words) else "")
        + ("C" if 100 * capitals > 10 * len(text) else "")
        + ("D" if any(c in "#$%&*|" for c in text) else "")
    )


def plain_words(rows) -> list[tuple]:
    """(doc_id, part, failed)"""
    least = {}
    for number, text, *_ in rows:
        if number is not None:
            least[text or ""] = min(number, least.get(text or "", number))
    return [
        (n, lang or "", plain_failures(t or "") + ("E" if n is not None and n > least[t or ""] else ""))
        for n, t, lang, *_ in rows
    ]


def plain_audit(rows, labels) -> list[tuple]:
    words = plain_words(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out, shapley = [], Counter()
    for part in {p for _, p, _ in words}:
        mine = [(n, w) for n, p, w in words if p == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, start=1):
                gone = [(n, w) for n, w in left if letter in w]
                left = [(n, w) for n, w in left if letter not in w]
                shapley[part, letter] += len(gone)
                out.append(
                    (
                        part,
                        "".join(order),
                        step,
                        len(left),
                        len(gone),
                        sum(letter in w for _, w in mine) - len(gone),
                        sum(w == letter for _, w in mine),
                        sum(n in good for n, _ in gone),
                        sum(n in toxic for n, _ in gone),
                        letter,
                    )
                )
    return sorted((*row[:-1], shapley[row[0], row[-1]]) for row in out)


LABELS = [(0, 1, 0), (1, 0, 1), (1, None, 0), (12, 1, 1), (13, 1, None), (20, 1, 0), (None, 1, 1), (5000, 1, 1)]
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def documents():
    rows = cases.documents()
    more = [
        (100, "x" * 50 + " SHOUTING " * 120, "de", None, 1, 0.1, "E"),
        (101, "price 5$ " + cases.prose(7, 150), None, None, 1, 0.1, "E"),
        (102, cases.prose(7, 150), "", None, 1, 0.1, "E"),
        (99, cases.prose(7, 150), "de", None, 1, 0.1, "E"),
        (98, "", "de", None, 0, 0.1, "E"),
        (None, "", "de", None, 0, 0.1, "E"),
        (None, None, None, None, 0, 0.1, "E"),
    ]
    return rows + more


def test_equals_plain_audit(spark):
    docs = spark.createDataFrame(documents(), cases.SCHEMA).repartition(5)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(docs, labels, ranges=4)
    assert set(out.columns) == set(COLUMNS)
    assert sorted(tuple(r) for r in out.select(*COLUMNS).collect()) == plain_audit(documents(), LABELS)


@pytest.mark.parametrize("docs, labels", [([], LABELS), ([], []), (documents()[:3], [])])
def test_empty_tables(spark, docs, labels):
    frame = spark.createDataFrame(docs, cases.SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(frame, marks, ranges=3)
    assert sorted(tuple(r) for r in out.select(*COLUMNS).collect()) == plain_audit(docs, labels)


def test_hot_texts_and_long_common_beginnings(spark, monkeypatch):
    dice = random.Random(5)
    header = "licence " * 300
    texts = ["the same text everywhere"] * 400
    texts += [header + cases.prose(dice.randrange(150), 5) for _ in range(400)]
    texts += [header[:2000] + "é" + cases.prose(k, 2) for k in range(100)]
    texts += ["a" * k for k in range(60)] * 2 + [None] * 50
    ids = list(range(len(texts)))
    dice.shuffle(ids)
    rows = [(i, t, "en", None, 0, 0.0, "k") for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(6)
    starts = filter_audit.range_starts(docs.select("text"), 12)
    assert len(starts) >= 8 and starts == sorted(starts)
    # The common beginning does not hold its texts together.
    assert sum(s.startswith(header[:2000].encode()) for s in starts) >= 4
    found = filter_audit.failed_filters(docs, 12)
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain_words(rows))
    # Only one row of a text and piece is sent on with its text.
    sent = docs.select("doc_id", "lang", "text").withColumnRenamed("lang", "part").coalesce(1).mapInArrow(
        lambda batches: filter_audit.settled_in_tasks(batches, starts),
        "doc_id long, part string, failed string, range int, text binary",
    )
    with_text = sent.filter("text = cast('the same text everywhere' AS binary)").count()
    assert with_text == 1


@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(c % 3 for c in b)), max_size=60))
def test_trie_holds_smallest_ids(texts):
    trie, least = filter_audit.RadixTrie(), {}
    nodes = [trie.insert(t, len(texts) - k) for k, t in enumerate(texts)]
    for k, t in enumerate(texts):
        least[t] = min(least.get(t, 1000), len(texts) - k)
    assert all(trie.least[n] == least[t] and trie.terminal(t) == n for n, t in zip(nodes, texts))


def test_long_texts_are_counted_alike(monkeypatch):
    texts = [cases.prose(1, 500), "A b\tC\x0bd é # \x1c x" * 40, ""]
    short = [filter_audit.failures(t.encode()) for t in texts]
    monkeypatch.setattr(filter_audit, "LONG_TEXT", -1)
    assert [filter_audit.failures(t.encode()) for t in texts] == short == [plain_failures(t) for t in texts]
