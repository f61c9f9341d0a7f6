"""Small tables with every odd case, and plain versions to compare with."""

from __future__ import annotations

import random
import zlib

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, words: int) -> str:
    dice = random.Random(seed)
    return " ".join(dice.choice(WORDS) + str(dice.randrange(50)) for _ in range(words))


def changed(text: str, every: int) -> str:
    words = text.split(" ")
    return " ".join(f"other{i}" if i % every == every - 1 else w for i, w in enumerate(words))


def documents() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, score, key): the last two clash with names used inside."""
    base = [prose(k, 60 + 10 * k) for k in range(12)]
    texts = [
        *base,
        base[0],  # exact copies
        base[0],
        changed(base[1], 40),  # near copies
        changed(base[2], 45),
        changed(changed(base[2], 45), 41),
        changed(base[3], 3),  # far
        base[4].upper(),
        None,
        "",
        " \t\n ",
        "one two three",
        "one two three",
        "été ça 日本 \U0001f600 naïve coöperate",
        base[5] + "\n" + base[6] + "\n\n" + base[7],
        "\n".join([base[8], prose(99, 30), base[8]]),
        " ".join(base) * 3,
        "x" * 5000,
    ]
    rows = [(k, t, "en", "src0", None if t is None else len(t), 0.5, "k") for k, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    rows.append((None, "a text without an id stands here alone", None, None, None, None, None))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"


def crc(value) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode())
