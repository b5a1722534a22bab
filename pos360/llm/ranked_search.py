"""Operator 12, ranked lexical search over bit-sliced Bloom signatures.

The index holds blocks of documents of like size. A block is a bit matrix with
a row for each signature bit and a column for each document, so that one row, a
slice, tells of all its documents at once whether the bit is set. A document
sets bits for each of its terms, and for each term again at every LEVEL that the
term's count reaches. Presence is never missed and sometimes overstated.

A query's terms, weighted, are summed over their slices: a document that has a
term at one level and not at the next holds it fewer times than the next level
says, which bounds its share of the score from above. Documents whose bound
stays below the exact score of the 20th best of some first 200 are excluded;
every other document is scored exactly from its text.

The index does not depend on the queries. Queries are taken in slices of a
bounded size, each against all rows; their counts over the corpus (documents
that hold a term, documents, terms) are exact."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pos360.llm import textarrays as ta
from pos360.llm.tables import pieces, read_table, remove, written
from pos360.session import shared_path

TOP = 20
HASHES = 7
BITS_PER_KEY = 14  # at least; a block has the next power of two
FIRST = 10  # times `top`: pairs of the largest bounds whose exact scores set the bar
BLOCK_BITS = 1 << 24
SLICE_BYTES = 1 << 20  # of query text in a task at a time
BROADCAST_PAIRS = 200_000  # (item, document) pairs that are sent to all tasks; more are joined by a shuffle
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.iinfo(np.int64).max
# Counts at which a term sets further bits: 1, 2, 3, 4, 6, 8, 12, 16, 24, ...
LEVELS = np.array([1, *sorted(x for i in range(1, 40) for x in (1 << i, 3 << (i - 1)))], np.int64)
_BLOCK = "bits int, ids array<long>, n array<long>, slices binary"


def terms(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, start, end, hash, offsets by text) of the texts' terms, A-Z lowered."""
    buf, off = ta.column_bytes(column)
    buf = ta.ASCII_LOWER[buf]
    start, end, words = ta.words(buf, off, ta.ALNUM_SEPARATORS)
    return buf, start, end, ta.hash_spans(buf, start, end), words


def rows_of_keys(term: np.ndarray, level, bits: int) -> np.ndarray:
    """Signature rows (one line per key, HASHES columns) of terms at a level."""
    h = ta.mix(term + np.asarray(level, np.uint64) * _STEP)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.int64)


class _Open:
    """A block that is being filled."""

    def __init__(self, bits: int) -> None:
        self.bits, self.room = bits, max(8, min(4096, BLOCK_BITS >> bits))
        self.matrix = np.zeros((1 << bits, self.room // 8), np.uint8)
        self.ids: list[int | None] = []
        self.n: list[int] = []

    def add(self, doc_id: int | None, n: int, rows: np.ndarray) -> None:
        at = len(self.ids)
        self.matrix[rows, at >> 3] |= 1 << (at & 7)
        self.ids.append(doc_id)
        self.n.append(n)

    def row(self) -> dict:
        used = -(-len(self.ids) // 8)
        return {"bits": self.bits, "ids": self.ids, "n": self.n, "slices": np.ascontiguousarray(self.matrix[:, :used]).tobytes()}


def build_index(docs: DataFrame) -> DataFrame:
    """Blocks of documents with at least one term; a task keeps one open block per size."""
    schema = pa.schema([("bits", pa.int32()), ("ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("slices", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        opened: dict[int, _Open] = {}
        for b in pieces(batches):
            _, _, _, h, off = terms(b["text"])
            doc = ta.row_of(off, len(h))
            by = np.lexsort((h, doc))
            h, doc = h[by], doc[by]
            first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][: len(h)])
            tf = np.diff(np.append(first, len(h)))
            levels = np.searchsorted(LEVELS, tf, "right")
            key = np.repeat(h[first], levels)
            level = np.arange(len(key)) - np.repeat(np.cumsum(levels) - levels, levels)
            at = np.searchsorted(np.repeat(doc[first], levels), np.arange(b.num_rows + 1))
            ids = b["doc_id"].to_pylist()
            for i in np.flatnonzero(np.diff(off)).tolist():
                mine = slice(at[i], at[i + 1])
                bits = max(6, math.ceil(math.log2(BITS_PER_KEY * (at[i + 1] - at[i]))))
                block = opened.setdefault(bits, None) or _Open(bits)
                opened[bits] = block
                block.add(ids[i], int(off[i + 1] - off[i]), rows_of_keys(key[mine], level[mine], bits).ravel())
                if len(block.ids) == block.room:
                    yield pa.RecordBatch.from_pylist([opened.pop(bits).row()], schema)
        while opened:
            yield pa.RecordBatch.from_pylist([opened.popitem()[1].row()], schema)

    return docs.mapInArrow(run, _BLOCK)


class Queries:
    """Items of one slice: their terms, and with the corpus counts their weights."""

    def __init__(self, texts: list[str]) -> None:
        self.buf, start, end, h, off = terms(pa.array(texts, pa.large_string()))
        self.hash, at, code = np.unique(h, return_index=True, return_inverse=True)
        self.start, self.length = start[at], (end - start)[at]
        self.items = [Counter(code[a:b].tolist()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        self.weight: np.ndarray | None = None

    def weigh(self, df: dict[int, int], documents: int, total: int) -> None:
        self.documents, self.total = documents, total
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(self.hash))], np.int64)
        self.of_item = [np.array(sorted(c), np.int64) for c in self.items]
        self.times = [np.array([c[t] for t in sorted(c)], np.int64) * self.weight[of] for c, of in zip(self.items, self.of_item)]

    def find(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the words, term) of the words that are query terms, byte by byte."""
        if not len(self.hash) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        place = np.flatnonzero((self.hash[at] == h) & (self.length[at] == end - start))
        at = at[place]
        here, there = ta.unaligned(buf), ta.unaligned(self.buf)
        same = np.ones(len(place), bool)
        for done in range(0, int(self.length.max()), 8):
            live = np.flatnonzero(same & (self.length[at] > done))
            short = np.minimum(self.length[at[live]] - done, 8).astype(np.uint64)
            differ = here[start[place[live]] + done] ^ there[self.start[at[live]] + done]
            same[live] = (differ & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - short * np.uint64(8)))) == 0
        return place[same], at[same]

    def share(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """A term's part of the score before its weight."""
        m = 75 + (25 * n * self.documents) // self.total
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)

    def bounds(self, bits: int, n: np.ndarray, slices: bytes) -> np.ndarray:
        """Upper bound of the score of each item (row) in each document (column) of a block."""
        used = -(-len(n) // 8)
        matrix = np.frombuffer(slices, np.uint8).reshape(-1, used)
        out = np.zeros((len(self.items), len(n)), np.int64)
        alive, has = np.arange(len(self.hash)), None
        before = np.zeros(len(n), np.int64)
        for j in range(len(LEVELS) - 1):
            rows = rows_of_keys(self.hash[alive], j, bits)
            found = np.bitwise_and.reduce(matrix[rows], axis=1)
            if has is not None:
                found &= has
            some = found.any(axis=1)
            alive, has = alive[some], found[some]
            if not len(alive):
                break
            most = self.share(np.minimum(LEVELS[j + 1] - 1, n), n)
            gain, before = most - before, most
            place = np.full(len(self.hash), -1)
            place[alive] = np.arange(len(alive))
            for i, of in enumerate(self.of_item):
                at = place[of]
                there = at >= 0
                if there.any():
                    present = np.unpackbits(has[at[there]], axis=1, count=len(n), bitorder="little")
                    out[i] += np.rint(self.times[i][there].astype(np.float64) @ present).astype(np.int64) * gain
        return out


def corpus_counts(docs: DataFrame, q: Queries) -> tuple[dict[int, int], int, int]:
    """(documents by query term, documents with a term, all terms), exact; one row a term and task travels."""

    def run(batches: Iterator[pa.RecordBatch]):
        df = np.zeros(len(q.hash) + 2, np.int64)
        for b in pieces(batches):
            buf, start, end, h, off = terms(b["text"])
            place, term = q.find(buf, start, end, h)
            both = np.unique(ta.row_of(off, len(h))[place] * len(q.hash) + term)
            df[:-2] += np.bincount(both % max(1, len(q.hash)), minlength=len(q.hash))
            df[-2:] += (np.count_nonzero(np.diff(off)), len(h))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], ["term", "n"])

    found = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r["term"]: r["n"] for r in found.collect()}  # at most a slice's terms
    return df, df.pop(len(q.hash), 0), df.pop(len(q.hash) + 1, 0)


def _blocks(batches: Iterator[pa.RecordBatch], q: Queries) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, bounds) of every block; a null id counts as the largest."""
    for b in batches:
        for r in range(b.num_rows):
            ids = b["ids"][r].values.fill_null(_LAST).to_numpy()
            yield ids, q.bounds(b["bits"][r].as_py(), b["n"][r].values.to_numpy(), b["slices"][r].as_buffer())


def _pairs(item: np.ndarray, doc: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=doc == _LAST), pa.array(bound, pa.int64())], ["item", "doc_id", "bound"])


def first_pairs(index: DataFrame, q: Queries, top: int) -> DataFrame:
    """(item, doc_id, bound) of the `top` largest bounds of each item."""

    def run(batches: Iterator[pa.RecordBatch]):
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in q.items]
        least = np.ones(len(q.items), np.int64)
        for ids, bound in _blocks(batches, q):
            for i in np.flatnonzero(bound.max(axis=1) >= least).tolist():
                here = np.flatnonzero(bound[i] >= least[i])
                b, d = np.append(best[i][0], bound[i][here]), np.append(best[i][1], ids[here])
                by = np.lexsort((d, -b))[:top]
                best[i] = b[by], d[by]
                if len(by) == top:
                    least[i] = b[by[-1]]
        for i, (b, d) in enumerate(best):
            yield _pairs(np.full(len(b), i), d, b)

    order = Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"))
    return index.mapInArrow(run, "item int, doc_id long, bound long").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("rank")


def open_pairs(index: DataFrame, q: Queries, least: np.ndarray, last: np.ndarray) -> DataFrame:
    """(item, doc_id, bound) of all documents that are not provably behind (least score, last id) of their item."""

    def run(batches: Iterator[pa.RecordBatch]):
        for ids, bound in _blocks(batches, q):
            item, at = np.nonzero((bound > least[:, None]) | ((bound == least[:, None]) & (ids <= last[:, None]) & (bound > 0)))
            yield _pairs(item, ids[at], bound[item, at])

    return index.mapInArrow(run, "item int, doc_id long, bound long")


def exact_scores(docs: DataFrame, pairs: DataFrame, q: Queries) -> DataFrame:
    """(item, doc_id, score above 0) of the pairs, from the whole texts."""
    wanted = pairs.groupBy("doc_id").agg(F.collect_set("item").alias("items"))
    if pairs.count() <= BROADCAST_PAIRS:
        wanted = F.broadcast(wanted)
    wanted = wanted.withColumnRenamed("doc_id", "id")
    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["id"])).select("doc_id", "text", "items")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches):
            buf, start, end, h, off = terms(b["text"])
            place, term = q.find(buf, start, end, h)
            doc = ta.row_of(off, len(h))[place]
            cut = np.searchsorted(doc, np.arange(b.num_rows + 1))
            n, out = np.diff(off), []
            for r, items in enumerate(b["items"].to_pylist()):
                tf = np.bincount(term[cut[r] : cut[r + 1]], minlength=len(q.hash))
                there = np.flatnonzero(tf)
                part = np.zeros(len(tf), np.int64)
                part[there] = q.share(tf[there], n[r])
                out += [(i, r, int((q.times[i] * part[q.of_item[i]]).sum())) for i in items]
            item, row, score = np.array([x for x in out if x[2] > 0], np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), b["doc_id"].take(pa.array(row)), pa.array(score, pa.int64())], ["item", "doc_id", "score"])

    return found.mapInArrow(run, "item int, doc_id long, score long")


def _ranked(scores: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `top` documents of the highest score above 0.

    Defined cases: null texts have no terms and never match; rows of one item_id
    (null is one, too) are one item with all their terms; an item without terms
    or matches has no rows; repeated doc_ids are documents of their own, a null
    doc_id comes after all others at equal scores; repeated terms of an item
    count each time; empty tables give no rows; other columns do not matter. An
    item is never cut in two: a slice exceeds slice_bytes by its largest item."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = next(f for f in items.schema if f.name.lower() == "item_id")
    whole = items.groupBy("item_id").agg(F.array_join(F.sort_array(F.collect_list(F.col("text").cast("string"))), " ").alias("text"))
    size = whole.agg(F.sum(F.octet_length("text") + 32)).head()[0] or 0
    slices = max(1, -(-size // slice_bytes))
    path = shared_path(spark, "signatures")
    build_index(docs).write.parquet(path)
    index = spark.read.parquet(path)
    answers = []
    for i in range(slices):
        rows = whole.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == i).collect()  # bounded by slice_bytes
        q = Queries([r["text"] for r in rows])
        q.weigh(*corpus_counts(docs, q))
        if not q.total:
            continue
        ranked = _ranked(exact_scores(docs, written(first_pairs(index, q, FIRST * top), "first-pairs"), q), top).where(F.col("rank") == top).collect()  # a row an item
        least, last = np.zeros(len(rows), np.int64), np.full(len(rows), _LAST)
        for r in ranked:
            least[r["item"]], last[r["item"]] = r["score"], _LAST if r["doc_id"] is None else r["doc_id"]
        pairs = written(open_pairs(index, q, least, last), "open-pairs")
        names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(rows)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind.dataType)]))
        answers.append(_ranked(exact_scores(docs, pairs, q), top).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    remove(spark, path)
    if not answers:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind.dataType), *T.StructType.fromDDL("rank int, doc_id long, score long")]))
    out = answers[0]
    for a in answers[1:]:
        out = out.unionByName(a)
    return out


def op12_bitsliced_search(spark, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
