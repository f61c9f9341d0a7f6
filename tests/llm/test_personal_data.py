"""Personal data: patterns against the plain expressions, the tagger against sums over all paths."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings as limits
from hypothesis import strategies as st

from larder.llm import personal_data as p
from tests.llm import cases


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        d = int(d) * (2 if place % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text: str) -> list[list[tuple]]:
    """The expressions as they are stated, leftmost and without overlap."""

    def spans(expression, fits):
        found = []
        for m in re.finditer(expression, text):
            if fits(re.sub("[^0-9]", "", m.group()), m):
                found.append(m.span())
        return found

    return [
        spans(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda d, m: True),
        spans(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda d, m: all(int(x) <= 255 for x in m.group().split("."))),
        spans(r"[0-9]([\x20-]?[0-9])+", lambda d, m: 13 <= len(d) <= 19 and luhn(d)),
        spans(r"\+[0-9][\x20().0-9-]+[0-9]", lambda d, m: 9 <= len(d) <= 15),
    ]


@limits(max_examples=400, deadline=None)
@given(st.one_of(st.text("a@.-0 ", max_size=30), st.text("0123.25 -+", max_size=40), st.text("+(4) .9é\n", max_size=30)))
def test_patterns_equal_plain_expressions(text):
    assert p.base_spans(text) == plain_base(text)


def test_patterns_of_known_texts():
    text = "é a.b@c.de, @x.y a@b c@d.e@f.g 1.2.3.4.5.6.7.8 256.1.1.1 007.0.0.0255, 4111-1111 1111 1111 +1 (555) 555-1234 +12345678"
    assert p.base_spans(text) == plain_base(text)
    assert [len(s) for s in p.base_spans(text)] == [2, 3, 1, 1]
    assert p.base_spans("") == [[], [], [], []]


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000, "+1" * 150_000, "a@" * 150_000])
def test_patterns_read_long_words_once(text):
    p.base_spans(text)


def small_tagger(monkeypatch, seed=3):
    monkeypatch.setattr(p, "HIDDEN", 3)
    monkeypatch.setattr(p, "EMBEDDED", 2)
    tagger = p.Tagger.new(seed)
    dice = np.random.default_rng(seed)
    tagger.moves[:] = dice.normal(0, 1, tagger.moves.shape)
    tagger.bias[:] = dice.normal(0, 1, tagger.bias.shape)
    return tagger


def path_score(scores, moves, path):
    return sum(scores[t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path))


def test_loss_and_paths_against_all_paths(monkeypatch):
    tagger = small_tagger(monkeypatch)
    dice = np.random.default_rng(1)
    x, y = dice.integers(0, p.CLASSES, (5, 4)), dice.integers(0, p.TAGS, (5, 4))
    scores = tagger.emissions(x.astype(np.uint8))
    paths = list(itertools.product(range(p.TAGS), repeat=5))
    loss = 0.0
    for k in range(4):
        each = np.array([path_score(scores[:, :, k], tagger.moves, path) for path in paths], float)
        loss += np.log(np.exp(each).sum()) - path_score(scores[:, :, k], tagger.moves, y[:, k])
        best = p.decoded(scores, tagger.moves)[:, k]
        assert tuple(best) == paths[each.argmax()] == tuple(tagger.tags(x.astype(np.uint8))[:, k])
        gained = each.max() - path_score(scores[:, :, k], tagger.moves, (0,) * 5)
        assert p.most_to_gain(scores, tagger.moves)[k] >= gained - 1e-4 or gained == 0
    assert np.isclose(p.loss_and_slopes(tagger, x, y)[0], loss / 20, rtol=1e-4)


def test_slopes_against_differences(monkeypatch):
    tagger = small_tagger(monkeypatch)
    dice = np.random.default_rng(2)
    x, y = dice.integers(0, p.CLASSES, (6, 8)), dice.integers(0, p.TAGS, (6, 8))
    tagger = p.Tagger(
        tagger.embedding.astype(float),
        [g.astype(float) for g in tagger.gates],
        [o.astype(float) for o in tagger.outputs],
        tagger.bias.astype(float),
        tagger.moves.astype(float),
    )
    _, slopes = p.loss_and_slopes(tagger, x, y)
    for weights, slope in zip(tagger.weights, slopes):
        for _ in range(6):
            at = tuple(dice.integers(0, n) for n in weights.shape)
            if weights is tagger.embedding:
                at = (at[0], x.flat[dice.integers(x.size)])
            kept = weights[at]
            losses = []
            for step in (1e-2, -1e-2):
                weights[at] = kept + step
                losses.append(p.loss_and_slopes(tagger, x, y)[0])
            weights[at] = kept
            assert np.isclose(slope[at], (losses[0] - losses[1]) / 2e-2, rtol=0.05, atol=2e-4)


class DigitTagger:
    """Tags digits by themselves, wherever a window begins."""

    def tags(self, x):
        return np.where((x >= 48) & (x < 53), 2, np.where((x >= 53) & (x < 58), 4, 0)).astype(np.uint8)


def test_windows_are_joined_over_the_whole_text(monkeypatch):
    monkeypatch.setattr(p, "WINDOW", 12)
    monkeypatch.setattr(p, "STEP", 8)
    monkeypatch.setattr(p, "AT_ONCE", 3)
    monkeypatch.setattr(p, "WAITING", 5)
    dice = random.Random(2)
    texts = ["".join(dice.choice("a1 19é") for _ in range(n)) for n in [*range(0, 60), 200, 97]]
    texts += ["1" * 100, ""]
    for text, found in zip(texts, p.tagged(DigitTagger(), texts)):
        assert found[1] == [m.span() for m in re.finditer("[0-4]+", text)]
        assert found[3] == [m.span() for m in re.finditer("[5-9]+", text)]


def letter(seed: int, rows: int, respell: bool):
    """(text, kind, span): prose with a span of personal data, as patterns know it or spelled otherwise."""
    dice = random.Random(seed)
    out = []
    for k in range(rows):
        kind = k % 4
        number = [str(dice.randrange(10)) for _ in range(15)]
        card = "4" + "".join(number[:14])
        card += next(d for d in "0123456789" if luhn(card + d))
        span = [
            f"{cases.WORDS[k % 18]}.{dice.randrange(99)}@mail{dice.randrange(9)}.example.com",
            ".".join(str(dice.randrange(1, 256)) for _ in range(4)),
            card,
            f"+1 ({''.join(number[:3])}) {''.join(number[3:6])}-{''.join(number[6:10])}",
        ][kind]
        if respell:
            span = {
                0: span.replace("@", " [at] ").replace(".com", " [dot] com"),
                1: span.replace(".", "[.]"),
                2: "/".join(span[i : i + 4] for i in range(0, 16, 4)),
                3: span[3:].replace("(", "").replace(") ", "-"),
            }[kind]
        before = "".join(c for c in cases.prose(seed * 1000 + k, 20) if not c.isdigit()) + " "
        out.append((before + span + " " + cases.prose(k, 6), kind, (len(before), len(before) + len(span))))
    return out


@pytest.fixture(scope="module")
def trained():
    windows = [w for text, _, _ in letter(1, 400, False) for w in p.teaching_windows(text)]
    return p.trained(sorted(windows), rounds=260)


def test_tagger_finds_what_patterns_miss(trained):
    found = wrong = 0
    rows = letter(2, 120, True)
    for (text, kind, span), seen in zip(rows, p.tagged(trained, [r[0] for r in rows])):
        base = p.base_spans(text)
        assert span not in base[kind]
        spans = p.all_spans(text, base, seen)
        found += span in spans[kind]
        wrong += sum(map(len, spans)) - sum(map(len, base)) - (span in spans[kind])
    assert found >= 0.7 * len(rows) and wrong <= 0.05 * len(rows)


def test_documents(spark, trained):
    rows = cases.documents()
    rows += [(200 + k, text, "en", None, None, 0.0, "k") for k, (text, _, _) in enumerate(letter(3, 8, False) + letter(4, 8, True))]
    rows.append((300, "ab " * 3000 + rows[-1][1] + " cd" * 3000, "en", None, None, 0.0, "k"))
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(3)
    found = p.personal_data(docs, trained).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in found:
        base = plain_base(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, of in zip(("email", "ip", "card", "phone"), base) for a, b in of)
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [len(b) for b in base]
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        spans = [s for s in r["spans"].split(",") if s]
        assert set(line.split(",")) - {""} <= set(spans)
        assert r["n_added"] == len(spans) - sum(map(len, base))
        order = [(("email", "ip", "card", "phone").index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)


def test_no_labels_and_no_rows(spark):
    empty = spark.createDataFrame([], cases.SCHEMA)
    assert p.personal_data(empty).count() == 0
    clean = spark.createDataFrame([(1, "nothing here", "en", None, 1, 0.0, "k"), (2, None, "en", None, 1, 0.0, "k")], cases.SCHEMA)
    out = p.personal_data(clean)
    assert out.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert {tuple(r[:5]) + (r["spans"],) for r in out.collect()} == {(1, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, "")}


def test_sample_is_bounded_and_repeatable(spark):
    rows = [(k, text, "en", None, None, 0.0, "k") for k, (text, _, _) in enumerate(letter(5, 200, False))]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    once = sorted(p.teaching_rows(docs.repartition(3), 60).select("kind", "piece", "start", "end").collect())
    again = sorted(p.teaching_rows(docs.repartition(7), 60).select("kind", "piece", "start", "end").collect())
    assert once == again and 30 <= sum(r["kind"] < 4 for r in once) <= 90
