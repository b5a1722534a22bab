"""Counts over whole texts, vectorised over a batch: words, lines, repeats, kinds of characters."""

from __future__ import annotations

import numpy as np

from pos360.llm import textarrays as ta

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_LETTERS = np.zeros(256, np.uint8)  # 1 capital, 2 digit, 3 punctuation
_LETTERS[0x41:0x5B], _LETTERS[0x30:0x3A], _LETTERS[list(b".,;:!?")] = 1, 2, 3


def repeated_windows(word: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Boolean per word: it lies in a window of k words found twice or more in its text."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(len(word), bool)
    text = ta.row_of(offsets, len(word))
    start = np.flatnonzero(text[:n] == text[k - 1 :])
    key = ta.rolling(word, k)[start] + text[start].astype(np.uint64) * ta._C2
    ta.mix(key)
    by = np.argsort(key)
    same = key[by][1:] == key[by][:-1]
    twice = np.zeros(len(start), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    return ta.mark_runs(len(word), start[twice], start[twice] + k)


def distinct(key: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Distinct keys of each text."""
    code = np.unique(ta.mix(key + text.astype(np.uint64) * ta._C2), return_index=True)[1]
    return np.bincount(text[code], minlength=n_texts)


def counts(column) -> dict[str, np.ndarray]:
    """Counts per text; words are what ASCII white space separates, lines what \\n does."""
    buf, off = ta.column_bytes(column)
    n = len(off) - 1
    body = buf[:-8]
    start, end, words = ta.words(buf, off, ta.SPACE_SEPARATORS)
    word = ta.hash_spans(buf, start, end)
    text = ta.row_of(words, len(word))
    code_point = (body & 0xC0) != 0x80
    blank = ta.SPACE_SEPARATORS[body]
    out = {
        "n_bytes": np.diff(off),
        "n_words": np.diff(words),
        "n_chars": ta.sums(code_point, off),
        "word_chars": ta.sums(code_point & ~blank, off),
        "n_symbols": ta.sums(SYMBOLS[body], off),
        "n_distinct_words": distinct(word, text, n),
        "n_repeat_words": ta.sums(repeated_windows(word, words, 8), words),
    }
    kind = _LETTERS[body]
    out |= {name: ta.sums(kind == i, off) for i, name in ((1, "n_capitals"), (2, "n_digits"), (3, "n_punctuation"))}
    out |= {name: ta.sums(body == byte, off) for name, byte in (("n_exclamations", 0x21), ("n_pipes", 0x7C), ("n_stops", 0x2E))}
    # Lines: cut at every \n and at the texts' ends.
    newline = np.flatnonzero(body == 0x0A)
    line_start = np.sort(np.concatenate([off[:-1], newline + 1]))
    line_end = np.sort(np.concatenate([newline, off[1:]]))
    line_text = np.repeat(np.arange(n), np.bincount(np.searchsorted(off, newline, "right") - 1, minlength=n) + 1)
    solid = np.zeros(len(body) + 1, np.int64)
    np.cumsum(~blank, out=solid[1:])
    full = np.flatnonzero(solid[line_end] > solid[line_start])
    line = ta.hash_spans(buf, line_start[full], line_end[full])
    out["n_lines"] = np.bincount(line_text[full], minlength=n)
    out["n_dup_lines"] = out["n_lines"] - distinct(line, line_text[full], n)
    return out
