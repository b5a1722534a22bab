"""Passages that occur more than once in a corpus, found and judged in blocks.

Both substring operators need the same thing: every window of L symbols (bytes
or words) that also starts earlier in the corpus. A text's windows are grouped
by their *anchor*, the leftmost symbol run of length k whose hash is smallest
among those inside the window. Equal windows have equal anchors at equal
offsets, so whatever repeats meets under its anchor's hash:

1. Texts get their anchors and go, once, to blocks of consecutive ids.
2. Hashes of the anchors' runs go to shards; those seen twice come back.
3. Each block sends one copy of every distinct region (the windows of one
   anchor, joined) whose anchor repeats; the operator's own index in the shard
   says which windows of that copy occur earlier, and answers the block.
4. The block applies the answers to all its copies.

A run that millions of texts share thus reaches its shard once per block, and
texts cross the network once: the blocks are one exchange that steps 2 to 4
read again. Hashes of 64 bits pick candidates and collapse equal regions of a
block; the shards compare the symbols themselves."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pos360.llm import textarrays as ta
from pos360.llm.tables import give_back, partitions, pieces

FIRST = -(2**63)  # order of a null id: before all others
U64, _LOW = np.uint64, np.uint64(0xFFFFFFFF)
_CHUNK = 1 << 19  # symbols whose windows are compared at a time, to stay in cache
#: A region sent: its hash (its name within the block), the id and position of its first copy, its windows, its bytes.
META = np.dtype([("region", "<u8"), ("order", "<i8"), ("pos", "<i4"), ("n", "<u2"), ("bytes", "<u4")])
ANSWER = np.dtype([("region", "<u8"), ("bits", "<u8")])


MOST_WINDOWS = 64  # of a region: its answer is one word of bits


def anchor_length(length: int, usual: int, step: int = 1) -> int:
    """Symbols of the anchor of windows of a length, a multiple of `step`: the
    usual number, fewer in shorter windows, more where a region could otherwise
    have more windows than an answer has bits."""
    if length < step:
        raise ValueError(f"windows must have {step} symbols at least")
    return max(min(usual, length // step * step), -(-(length - MOST_WINDOWS + 1) // step) * step)


@dataclass
class Symbols:
    """Symbols of many texts: symbol i is buf[start(i):end(i)], and regions of
    equal symbols are equal byte spans of buf."""

    buf: np.ndarray
    offsets: np.ndarray  # of each text's symbols
    start: np.ndarray | None  # None: each byte is a symbol
    end: np.ndarray | None
    grams: Callable[[np.ndarray | slice], np.ndarray]  # hashes of the k-runs that start at positions

    def span(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (first, last + 1) if self.start is None else (self.start[first], self.end[last])


@dataclass(frozen=True)
class Rule:
    """What a window is, and whether a copy in the same document counts."""

    length: int
    k: int
    same_document: bool
    symbols: Callable[[pa.ChunkedArray | pa.Array], Symbols]


def byte_symbols(k: int) -> Callable[[pa.ChunkedArray | pa.Array], Symbols]:
    """Bytes of the texts; runs of k bytes, k a multiple of 8."""

    def symbols(column) -> Symbols:
        buf, offsets = ta.column_bytes(column)
        w = ta.unaligned(buf)

        def grams(at: np.ndarray | slice) -> np.ndarray:
            h = np.zeros(at.stop - at.start if isinstance(at, slice) else len(at), U64)
            for i in range(0, k, 8):
                h += w[at.start + i : at.stop + i] if isinstance(at, slice) else w[at + i]
                h *= ta._C1
                h ^= h >> U64(32)
            return ta.mix(h)

        return Symbols(buf, offsets, None, None, grams)

    return symbols


def word_symbols(k: int) -> Callable[[pa.ChunkedArray | pa.Array], Symbols]:
    """Words between ASCII white space; runs of k words. The buffer holds the
    words joined by single spaces, so that equal word runs are equal bytes."""

    def symbols(column) -> Symbols:
        buf, offsets = ta.column_bytes(column)
        start, end, word_offsets = ta.words(buf, offsets, ta.SPACE_SEPARATORS)
        length = end - start
        to = np.zeros(len(start) + 1, np.int64)
        np.cumsum(length + 1, out=to[1:])
        joined = np.full(to[-1] + 8, 0x20, np.uint8)
        inside = ta.mark_runs(len(buf) - 8, start, end)
        place = np.ones(to[-1], bool)
        place[to[1:] - 1] = False
        joined[:-8][place] = buf[:-8][inside]
        joined[-8:] = 0
        word = ta.hash_spans(joined, to[:-1], to[1:] - 1)

        def grams(at: np.ndarray | slice) -> np.ndarray:
            return ta.rolling(word[at.start : at.stop + k - 1], k) if isinstance(at, slice) else ta.rolling(word, k)[at]

        return Symbols(joined, word_offsets, to[:-1], to[1:] - 1, grams)

    return symbols


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n]) if span < width else x[:n]


def anchor_runs(s: Symbols, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor), in order of position: the
    windows of a text are cut into runs that share their anchor."""
    off, width = s.offsets, rule.length - rule.k + 1
    firsts, counts, anchors = [], [], []
    text = 0
    while text < len(off) - 1:
        last = max(text + 1, int(np.searchsorted(off, off[text] + _CHUNK, "right")) - 1)
        a, b = int(off[text]), int(off[last])
        n = b - a - rule.length + 1
        if n > 0:
            g = s.grams(slice(a, b - rule.k + 1))
            key = (g & ~_LOW) | np.arange(len(g), dtype=U64)
            at = (sliding_min(key, width) & _LOW).astype(np.int64)
            valid = np.ones(n, bool)
            ends = off[text + 1 : last + 1] - a
            bad_from = np.clip(np.maximum(ends - rule.length + 1, off[text:last] - a), 0, n)
            valid &= ~ta.mark_runs(n, bad_from, np.clip(ends, 0, n))
            new = valid.copy()
            new[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
            first = np.flatnonzero(new)
            stop = valid & np.append((at[1:] != at[:-1]) | ~valid[1:], True)
            firsts.append(first + a)
            counts.append(np.flatnonzero(stop) - first + 1)
            anchors.append(at[first] + a)
        text = last
    if not firsts:
        z = np.zeros(0, np.int64)
        return z, z, z
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(anchors)


def pack_marks(s: Symbols, first: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> pa.Array:
    """Runs of each text as (number of windows, anchor offset) bytes: the runs
    of a text follow each other without gaps, so nothing else is needed."""
    marks = np.empty((len(first), 2), np.uint8)
    marks[:, 0], marks[:, 1] = count, anchor - first
    ends = np.searchsorted(first, s.offsets) * 2
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(marks.tobytes())]).cast(pa.binary())


def unpack_marks(s: Symbols, marks: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor, text) of all runs."""
    raw, off = ta.column_bytes(marks)
    pairs = raw[:-8].reshape(-1, 2).astype(np.int64)
    runs = off // 2
    text = np.repeat(np.arange(len(off) - 1), np.diff(runs))
    total = np.zeros(len(pairs) + 1, np.int64)
    np.cumsum(pairs[:, 0], out=total[1:])
    first = total[:-1] - total[runs[text]] + s.offsets[text]
    return first, pairs[:, 0], first + pairs[:, 1], text


def _blobs(schema: pa.Schema, key: str, of: np.ndarray, **columns: tuple[np.ndarray, np.ndarray] | int) -> Iterator[pa.Table]:
    """One row per distinct value of `of` (ascending); a column's entry is the
    bytes between its offsets, an int is the same in all rows."""
    cut = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(of))
    out = {key: pa.array(of[cut], pa.int32())}
    for name, c in columns.items():
        if isinstance(c, int):
            out[name] = pa.array(np.full(len(cut), c), schema.field(name).type)
        else:
            raw, at = c
            view = raw.tobytes()
            out[name] = pa.array([view[at[a] : at[b]] for a, b in zip(cut.tolist(), ends.tolist())], pa.binary())
    return pa.table(out).select(schema.names).cast(schema)


_KEYS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("twice", pa.binary())])
_SEEN = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary())])
_REGIONS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("meta", pa.binary()), ("content", pa.binary())])
_ANSWERS = pa.schema([("block", pa.int32()), ("answer", pa.binary())])


def packed(table: pa.Table) -> pa.Table:
    """The regions' contents compressed, one blob of a block at a time: they overlap, and most of the bytes sent are theirs."""
    c = zstandard.ZstdCompressor(level=1)
    at = table.schema.get_field_index("content")
    return table.set_column(at, "content", pa.array([c.compress(x) for x in table["content"].to_pylist()], pa.binary()))


def unpacked(table: pa.Table) -> pa.Table:
    d = zstandard.ZstdDecompressor()
    at = table.schema.get_field_index("content")
    return table.set_column(at, "content", pa.array([d.decompress(x) for x in table["content"].to_pylist()], pa.binary()))


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in schema)


def _shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> U64(32)) % U64(shards)).astype(np.int32)


def _blocks(docs: DataFrame, rule: Rule, n_blocks: int) -> DataFrame:
    """The documents with their anchors, by block of consecutive ids.

    An id that holds more rows than a block should is spread over as many
    blocks as it fills, by row number."""
    names = [c for c in docs.columns if c != "text"]
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("order"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("rest"),
        F.monotonically_increasing_id().alias("row"),
    )
    cuts = np.array(rows.approxQuantile("order", [i / n_blocks for i in range(1, n_blocks)], 1 / (8 * n_blocks)) if n_blocks > 1 else [], float)
    out_schema = T.StructType([T.StructField("block", T.IntegerType()), *[rows.schema[c] for c in ("order", "text", "rest")], T.StructField("marks", T.BinaryType())])

    def mark(batches):
        for b in pieces(batches):
            order = np.asarray(b["order"]).astype(float)
            low, high = np.searchsorted(cuts, order, "left"), np.searchsorted(cuts, order, "right")
            block = low + np.asarray(b["row"]) % np.maximum(1, high - low)
            s = rule.symbols(b["text"])
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), b["order"], b["text"], b["rest"], pack_marks(s, *anchor_runs(s, rule))], ["block", "order", "text", "rest", "marks"])

    return rows.mapInArrow(mark, out_schema).repartition(partitions(docs.sparkSession), "block")


def repeated_passages(
    docs: DataFrame,
    rule: Rule,
    judge: Callable[[pa.Table], Iterator[tuple[int, np.ndarray]]],
    finish: Callable[[pa.Table, list[np.ndarray], Symbols], pa.Table],
    out_schema: str | T.StructType,
) -> DataFrame:
    """Rows that `finish` makes of each block's texts and their flagged windows.

    judge(regions of a shard): yields (block, ANSWER records), for each region
    sent the bits of its windows that occur earlier in another region.
    finish(block's rows, flagged windows' starts per text, symbols): the result."""
    spark = docs.sparkSession
    n_blocks = n_shards = 2 * partitions(spark)

    def keys(batches):
        for b in pieces(batches):
            s = rule.symbols(b["text"])
            _, _, anchor, text = unpack_marks(s, b["marks"])
            h, block, order = s.grams(anchor), np.asarray(b["block"])[text], np.asarray(b["order"])[text]
            for one in np.unique(block):
                mine = np.flatnonzero(block == one)
                g, who = h[mine], order[mine]
                by = np.lexsort((g & _LOW, _shard_of(g, n_shards)))
                g, who = g[by], who[by]
                code = (_shard_of(g, n_shards).astype(U64) << U64(32)) | (g & _LOW)
                new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                size = np.diff(np.append(new, len(code)))
                twice = size > 1 if rule.same_document else np.minimum.reduceat(who, new) != np.maximum.reduceat(who, new)
                code = code[new]
                at = np.arange(len(code) + 1)
                yield from _blobs(_KEYS, "shard", (code >> U64(32)).astype(np.int32), block=int(one), keys=((code & _LOW).astype("<u4"), at * 4), twice=(twice.astype(np.uint8), at)).to_batches()

    def seen(table: pa.Table) -> pa.Table:
        sizes = np.array([len(x) // 4 for x in table["keys"].to_pylist()])
        k = np.frombuffer(b"".join(table["keys"].to_pylist()), "<u4")
        twice = np.frombuffer(b"".join(table["twice"].to_pylist()), np.uint8)
        block = np.repeat(np.asarray(table["block"]), sizes)
        by = np.lexsort((block, k))
        k, block, twice = k[by], block[by], twice[by]
        new = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        size = np.diff(np.append(new, len(k)))
        again = np.repeat((size > 1) | (np.maximum.reduceat(twice, new) > 0), size)
        k, block = k[again], block[again]
        by = np.lexsort((k, block))
        k, block = k[by], block[by]
        keep = np.r_[True, (k[1:] != k[:-1]) | (block[1:] != block[:-1])] if len(k) else np.zeros(0, bool)
        k, block = k[keep], block[keep]
        return _blobs(_SEEN, "block", block, shard=int(table["shard"][0].as_py()), keys=(k.astype("<u4"), np.arange(len(k) + 1) * 4))

    def runs(left: pa.Table):
        s = rule.symbols(left["text"])
        first, count, anchor, text = unpack_marks(s, left["marks"])
        return s, first, count, anchor, text, np.asarray(left["order"])[text]

    def region_hash(s: Symbols, first, count) -> np.ndarray:
        a, b = s.span(first, first + count + rule.length - 2)
        return ta.hash_spans(s.buf, a, b) ^ (count.astype(U64) * ta._C3)

    def regions(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _REGIONS.empty_table()
        give_back()
        s, first, count, anchor, text, order = runs(left)
        h = s.grams(anchor)
        shard = _shard_of(h, n_shards)
        known = [(int(n) << 32) | np.frombuffer(x, "<u4").astype(np.int64) for n, x in zip(right["shard"].to_pylist(), right["keys"].to_pylist())]
        known = np.sort(np.concatenate(known))
        code = (shard.astype(np.int64) << 32) | (h & _LOW).astype(np.int64)
        at = np.minimum(np.searchsorted(known, code), len(known) - 1)
        hit = np.flatnonzero(known[at] == code)
        first, count, text, order, shard = first[hit], count[hit], text[hit], order[hit], shard[hit]
        pos = first - s.offsets[text]
        r = region_hash(s, first, count)
        by = np.lexsort((pos, order, r))
        keep = by[np.r_[True, r[by][1:] != r[by][:-1]]] if len(by) else by
        keep = keep[np.argsort(shard[keep], kind="stable")]
        first, count, order, pos, shard, region = first[keep], count[keep], order[keep], pos[keep], shard[keep], r[keep]
        a, b = s.span(first, first + count + rule.length - 2)
        meta = np.empty(len(keep), META)
        meta["region"], meta["order"], meta["pos"], meta["n"], meta["bytes"] = region, order, pos, count, b - a
        at = np.zeros(len(keep) + 1, np.int64)
        np.cumsum(b - a, out=at[1:])
        index = np.repeat(a - at[:-1], b - a) + np.arange(at[-1])
        return packed(_blobs(_REGIONS, "shard", shard, block=int(left["block"][0].as_py()), meta=(meta, np.arange(len(keep) + 1) * META.itemsize), content=(s.buf[index], at)))

    def judged(table: pa.Table) -> pa.Table:
        out = [(block, a) for block, a in judge(unpacked(table)) if len(a)]
        give_back()
        return pa.table([pa.array([b for b, _ in out], pa.int32()), pa.array([a.tobytes() for _, a in out], pa.binary())], schema=_ANSWERS)

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"_": pa.array([])}).slice(0, 0)
        give_back()
        s, first, count, _, text, order = runs(left)
        pos = first - s.offsets[text]
        r = region_hash(s, first, count)
        by = np.lexsort((pos, order, r))
        new = np.r_[True, r[by][1:] != r[by][:-1]] if len(by) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        lead = by[new][group]
        later = order[by] > order[lead]
        if rule.same_document:
            later |= (order[by] == order[lead]) & (pos[by] > pos[lead])
        told = np.zeros(int(new.sum()), U64)
        if right.num_rows:
            answer = np.frombuffer(b"".join(right["answer"].to_pylist()), ANSWER)
            np.bitwise_or.at(told, np.searchsorted(r[by][new], answer["region"]), answer["bits"])
        bits = np.empty(len(first), U64)
        bits[by] = np.where(later, U64(0xFFFFFFFFFFFFFFFF), told[group])
        flagged = np.flatnonzero(bits)
        n = count[flagged]
        window = np.repeat(first[flagged] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        on = ((np.repeat(bits[flagged], n) >> (window - np.repeat(first[flagged], n)).astype(U64)) & U64(1)).astype(bool)
        window, whose = window[on], np.repeat(text[flagged], n)[on]
        per_text = np.split(window - s.offsets[whose], np.cumsum(np.bincount(whose, minlength=left.num_rows))[:-1])
        return finish(left, per_text, s)

    blocks = _blocks(docs, rule, n_blocks)
    sent = blocks.mapInArrow(keys, _ddl(_KEYS)).groupBy("shard").applyInArrow(seen, _ddl(_SEEN))
    asked = blocks.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(regions, _ddl(_REGIONS))
    answers = asked.groupBy("shard").applyInArrow(judged, _ddl(_ANSWERS))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, out_schema)
