"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def dedup_bytes(docs: list[tuple[int, str | None]], length: int = 50) -> list[tuple]:
    data = [(i, (t or "").encode()) for i, t in docs]
    first: dict[bytes, int] = {}
    for i, b in data:
        for j in range(len(b) - length + 1):
            first[b[j : j + length]] = min(i, first.get(b[j : j + length], i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if first[b[j : j + length]] < i:
                gone[j : j + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), len(b) - len(kept), spans, sha(kept)))
    return out


def dedup_words(docs: list[tuple[int, str | None]], window: int = 20) -> list[tuple]:
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    first: dict[tuple, tuple] = {}
    for i, w in words:
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            first[key] = min((i, j), first.get(key, (i, j)))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < (i, j):
                gone[j : j + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())))
    return out


def fingerprint(text: str | None, k: int = 3) -> int:
    w = WORD.findall(lower(text or ""))
    shingles = [" ".join(w[j : j + k]) for j in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints: list[int], bits: int = 2) -> list[int]:
    """Index of the first fingerprint reachable from each over links."""
    up = list(range(len(prints)))

    def top(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(prints))]


def base_counts(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    found = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
    again = {x for j in range(len(w) - 7) if found[tuple(w[j : j + 8])] > 1 for x in range(j, j + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def contamination(docs: list[tuple], items: list[tuple], window: int = 13) -> list[tuple]:
    windows: dict[tuple, set] = {}
    for i, t in items:
        w = ALNUM.findall(lower(t or ""))
        n = min(window, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[j : j + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w = ALNUM.findall(lower(t or ""))
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if items_here := windows.get(tuple(w[j : j + n])):
                    found |= items_here
                    hit[j : j + n] = [True] * n
        out.append((i, len(w), sum(hit), len(found), sha(",".join(sorted(found)).encode()), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out
