"""Small awkward corpora for the tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `order` string, block int, `rest` string"
PASSAGE = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder what all the running is about today"


def texts(seed: int = 5, n: int = 60) -> list[str | None]:
    """Prose with copies, near copies, shared passages, periodic text, empty, long and odd texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß語") for _ in range(rng.randint(1, 7))) for _ in range(80)]

    def prose(k: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(k))

    out: list[str | None] = [None, "", " ", "\n\t", "one", "Two words", "x" * 49, "x" * 50, "x" * 51, "ab" * 400, "word " * 90, "é" * 60, "nul\x00\x00" * 30]
    for _ in range(n):
        text = prose(rng.randint(1, 60))
        if rng.random() < 0.4:
            text += rng.choice([" ", "\n", "  "]) + PASSAGE[rng.randint(0, 30) :] + "\r\n" + prose(rng.randint(0, 30))
        out.append(text)
        if rng.random() < 0.3:
            out.append(text)
        if rng.random() < 0.3:
            out.append(text.upper() if rng.random() < 0.5 else text + " " + rng.choice(vocabulary))
    out.append(prose(4000) + " " + PASSAGE)
    out.append(PASSAGE)
    return out


def rows(found: list[str | None], ids: list[int | None] | None = None) -> list[tuple]:
    ids = ids or list(range(len(found)))
    langs = ["en", "de", None]
    return [(i, t, langs[n % 3], "s" if n % 3 else "hot", None if t is None else len(t), "o", n, "r") for n, (i, t) in enumerate(zip(ids, found))]
