"""Texts of an Arrow batch as one byte buffer: vectorised words and hashes.

All functions work on the concatenated UTF-8 bytes of many texts, so that one
numpy call serves thousands of documents. Nothing here knows about Spark."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_C1, _C2, _C3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
# Words longer than this are hashed one by one instead of in lockstep.
_LOCKSTEP_BYTES = 512

# Separators of the two word definitions, by byte value.
SPACE_SEPARATORS = np.zeros(256, bool)
SPACE_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
ALNUM_SEPARATORS = np.zeros(256, bool)
ALNUM_SEPARATORS[: 0x80] = True
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    ALNUM_SEPARATORS[_lo : _hi + 1] = False
# A-Z to a-z on bytes (capitals are separators once lowered away).
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values in place so that every input bit reaches every output bit."""
    h ^= h >> U64(30)
    h *= _C2
    h ^= h >> U64(27)
    h *= _C3
    h ^= h >> U64(31)
    return h


def column_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buffer, offsets) of a string or binary column; nulls count as empty.

    The buffer has 8 zero bytes behind the last text, for unaligned loads."""
    if isinstance(column, pa.ChunkedArray):
        column = column.cast(pa.large_binary()).combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.large_binary())
    else:
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(8, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    buf = np.zeros(offsets[-1] - offsets[0] + 8, np.uint8)
    buf[:-8] = raw[offsets[0] : offsets[-1]]
    return buf, offsets - offsets[0]


def unaligned(buf: np.ndarray) -> np.ndarray:
    """Little-endian 64-bit value that starts at each byte (last 7 bytes excluded)."""
    return np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))


def words(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word_offsets): maximal runs of non-separator bytes, never
    across two texts; text t has the words word_offsets[t] to word_offsets[t+1]."""
    total = int(offsets[-1])
    inside = np.zeros(total + 1, bool)
    np.logical_not(separators[buf[:total]], out=inside[:-1])
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    last = inside[:-1] & ~inside[1:]
    inner = offsets[1:-1]
    cut = inner[(inner > 0) & (inner < total)]  # texts that touch without a separator
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes a round over all spans that are still open."""
    length = (end - start).astype(np.int64)
    h = length.astype(U64) * _C1 + _C3
    words64 = unaligned(buf)
    long = np.flatnonzero(length > _LOCKSTEP_BYTES)
    live = np.flatnonzero((length > 0) & (length <= _LOCKSTEP_BYTES)) if len(long) else np.flatnonzero(length > 0)
    done = 0
    while len(live):
        left = length[live] - done
        w = words64[start[live] + done]
        short = np.minimum(left, 8).astype(U64)
        w &= U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - short * U64(8))
        g = h[live] ^ w
        g *= _C1
        g ^= g >> U64(32)
        g *= _C2
        g ^= g >> U64(29)
        h[live] = g
        done += 8
        live = live[left > 8]
    mix(h)
    if len(long):
        view = memoryview(buf)
        h[long] = [xxhash.xxh64_intdigest(view[s:e], 7) for s, e in zip(start[long].tolist(), end[long].tolist())]
    return h


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive symbols, from the symbols' hashes."""
    if len(h) < k:
        return np.zeros(0, U64)
    out = np.zeros(len(h) - k + 1, U64)
    for i in range(k):
        out *= _C1
        out += h[i : len(h) - k + 1 + i]
        if i & 3 == 3:
            out ^= out >> U64(31)
    return mix(out)


def mark_runs(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Boolean array of n items, true where one of the half-open runs covers it."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values in each slice given by offsets (empty slices give 0)."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


def row_of(offsets: np.ndarray, n: int) -> np.ndarray:
    """Slice number of each of n items."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:n]


def same_spans(a: np.ndarray, start_a: np.ndarray, b: np.ndarray, start_b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of buffer a equal those of buffer b, byte by byte, eight a round."""
    here, there = unaligned(a), unaligned(b)
    same = np.ones(len(length), bool)
    live, done = np.flatnonzero(length > 0), 0
    while len(live):
        short = np.minimum(length[live] - done, 8).astype(U64)
        differ = here[start_a[live] + done] ^ there[start_b[live] + done]
        same[live] = (differ & (U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - short * U64(8)))) == 0
        done += 8
        live = live[same[live] & (length[live] > done)]
    return same


def span_codes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Number of each span's content among the distinct ones; h are the spans' hashes, equal contents are told apart by bytes."""
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    length = end - start
    like = first[code]
    if (length == length[like]).all() and same_spans(buf, start, buf, start[like], length).all():
        return code
    known: dict[bytes, int] = {}  # two contents of one hash
    data = buf.tobytes()
    return np.array([known.setdefault(data[s:e], len(known)) for s, e in zip(start.tolist(), end.tolist())], np.int64)
