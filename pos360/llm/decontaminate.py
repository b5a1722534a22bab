"""Operator 8, benchmark decontamination with suffix arrays of the training text.

Every batch of documents is a shard with its own suffix array: the word
sequences that start at its positions, sorted to the depth of a window. Every
suffix of the benchmark is searched in it by bisection; the interval found
holds all verbatim occurrences, and occurrences that follow each other on one
diagonal make the longest matches and their places. Suffixes that cannot start
a match, because one of their next word pairs is in no benchmark item, are left
out of the array.

The benchmark is handed to the tasks in slices of a checked size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pos360.llm import textarrays as ta
from pos360.llm.tables import packed, pieces, read_table, written

WINDOW_WORDS = 13
SLICE_BYTES = 3 << 20  # of benchmark text in a task at a time; its index takes some 18 times as much
_MATCH = "array<struct<item_id:string,item_start:long,doc_start:long,length:long>>"


def lower_words(column) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, offsets of each text's words): A-Z lowered, words of digits, letters and non-ASCII."""
    buf, off = ta.column_bytes(column)
    buf = ta.ASCII_LOWER[buf]
    start, end, words = ta.words(buf, off, ta.ALNUM_SEPARATORS)
    return ta.hash_spans(buf, start, end), words


class Benchmark:
    """Suffixes of the benchmark's items, ready to be searched in suffix arrays."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int) -> None:
        word, off = lower_words(texts)
        self.window = window
        self.vocabulary = np.unique(word)
        code = np.searchsorted(self.vocabulary, word).astype(np.int64) + 1
        size = np.diff(off)
        item = ta.row_of(off, len(word))
        place = np.arange(len(word)) - off[item]
        length = np.minimum(size, window)
        starts = np.flatnonzero(place <= (size - length)[item])
        self.ids, self.item, self.start = ids, item[starts], place[starts]
        self.length = length[item[starts]]
        self.shortest = int(self.length.min()) if len(starts) else 0
        depth = np.arange(window)
        rows = np.where(depth < self.length[:, None], code[np.minimum(starts[:, None] + depth, max(0, len(code) - 1))] if len(code) else 0, 0)
        self.low = sort_keys(rows)
        self.high = sort_keys(np.where(depth < self.length[:, None], rows, 0xFFFFFFFF))
        inside = np.flatnonzero(item[1:] == item[:-1])
        self.pairs = np.unique((code[inside] << 32) | code[inside + 1])

    def codes(self, word: np.ndarray) -> np.ndarray:
        """Number of each word in the vocabulary, 0 outside it."""
        at = np.minimum(np.searchsorted(self.vocabulary, word), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == word, at + 1, 0)

    def suffix_array(self, code: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sorted suffix keys, their positions) of the shard's words that can start a match."""
        n, need = len(code), self.shortest
        end = off[1:][ta.row_of(off, n)]
        can = code > 0
        if need > 1:
            pair = np.zeros(n, bool)
            both = np.flatnonzero(can[:-1] & can[1:] & (end[:-1] == end[1:]))
            value = (code[both] << 32) | code[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, value), len(self.pairs) - 1)
            pair[both] = self.pairs[at] == value
            run = np.zeros(n + 1, np.int64)
            np.cumsum(pair, out=run[1:])
            last = np.minimum(np.arange(n) + need - 1, n)
            can &= run[last] - run[:-1] == need - 1
        position = np.flatnonzero(can)
        at = position[:, None] + np.arange(self.window)
        rows = np.where(at < end[position][:, None], code[np.minimum(at, n - 1)], 0)
        key = sort_keys(rows)
        by = np.argsort(key, kind="stable")
        return key[by], position[by]

    def search(self, code: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(benchmark suffix, word position) of all occurrences in the shard."""
        none = np.zeros(0, np.int64)
        if not len(self.low):
            return none, none
        key, position = self.suffix_array(code, off)
        low, high = np.searchsorted(key, self.low, "left"), np.searchsorted(key, self.high, "right")
        n = np.maximum(high - low, 0)
        suffix = np.repeat(np.arange(len(n)), n)
        return suffix, position[np.arange(n.sum()) + np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n)]


def sort_keys(rows: np.ndarray) -> np.ndarray:
    """Rows of 32-bit numbers as byte strings that sort alike."""
    rows = np.ascontiguousarray(rows.astype(">u4"))
    return rows.view(f"S{4 * rows.shape[1]}").ravel()


def _matches(b: Benchmark, text: np.ndarray, suffix: np.ndarray, place: np.ndarray) -> dict[int, list[dict]]:
    """Longest match of each item in each text, from occurrences at places in their texts."""
    item, start, length = b.item[suffix], b.start[suffix], b.length[suffix]
    by = np.lexsort((start, place - start, item, text))
    item, start, length, place, text = item[by], start[by], length[by], place[by], text[by]
    new = np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (place[1:] - start[1:] != place[:-1] - start[:-1]) | (start[1:] != start[:-1] + 1)]
    cut = np.flatnonzero(new)
    last = np.append(cut[1:], len(new)) - 1
    total = start[last] + length[last] - start[cut]
    out: dict[int, dict[str, dict]] = {}
    for t, i, s, p, n in zip(text[cut].tolist(), item[cut].tolist(), start[cut].tolist(), place[cut].tolist(), total.tolist()):
        best = out.setdefault(t, {})
        if b.ids[i] not in best or best[b.ids[i]]["length"] < n:
            best[b.ids[i]] = {"item_id": b.ids[i], "item_start": s, "doc_start": p, "length": n}
    return {t: [best[k] for k in sorted(best)] for t, best in out.items()}


def _found(docs: DataFrame, b: Benchmark) -> DataFrame:
    """docs with n_words, hit (covered word spans) and matches."""
    rest = [f for f in docs.schema]
    schema = T.StructType([*rest, *T.StructType.fromDDL(f"`#n_words` long, `#hit` array<struct<from:long,to:long>>, `#matches` {_MATCH}")])
    hit_type = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    match_type = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in pieces(batches):
            text = batch["text"] if pa.types.is_string(batch["text"].type) else batch["text"].cast(pa.string())
            word, off = lower_words(text)
            n = batch.num_rows
            hit, matches = [[] for _ in range(n)], [[] for _ in range(n)]
            if len(word) and len(b.vocabulary):
                suffix, position = b.search(b.codes(word), off)
                if len(suffix):
                    who = ta.row_of(off, len(word))[position]
                    for t, m in _matches(b, who, suffix, position - off[who]).items():
                        matches[t] = m
                    covered = ta.mark_runs(len(word), position, position + b.length[suffix])
                    for t in np.unique(who).tolist():
                        edge = np.flatnonzero(np.diff(np.r_[False, covered[off[t] : off[t + 1]], False].astype(np.int8)))
                        hit[t] = [{"from": x, "to": y} for x, y in edge.reshape(-1, 2).tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(off), pa.int64()), pa.array(hit, hit_type), pa.array(matches, match_type)], [*batch.schema.names, "#n_words", "#hit", "#matches"])

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """docs with `#n_words`, `#n_hit`, `#items` (sorted ids of items with occurring windows), `#matches`, `#contaminated`.

    Defined cases: null texts have no words and hit nothing; benchmark rows that
    share an id are one item, a null id is written as the empty string; an empty
    benchmark hits nothing; null or repeated document ids are judged row by row;
    the added names start with # and other columns pass through. A benchmark
    above slice_bytes is worked off in slices, each of which reads the documents
    once; their hits are merged by row."""
    spark = docs.sparkSession
    docs = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 16)).head()[0] or 0
    slices = max(1, -(-size // slice_bytes))

    def part(i: int) -> Benchmark:
        # A slice is bounded by slice_bytes on average; an item always stays whole.
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == i).toArrow()
        return Benchmark(rows["id"].to_pylist(), rows["text"], window)

    if slices == 1:
        found = _found(docs, part(0))
    else:
        numbered = written(docs.withColumn("#row", F.monotonically_increasing_id()), "decontaminate")
        keys = numbered.select("#row", "text")
        n_words = None
        for i in range(slices):
            one = written(_found(keys, part(i)).drop("text"), "decontaminate-slice")
            n_words = one if n_words is None else n_words.unionByName(one)
        together = n_words.groupBy("#row").agg(F.first("#n_words").alias("#n_words"), F.flatten(F.collect_list("#hit")).alias("#hit"), F.flatten(F.collect_list("#matches")).alias("#matches"))
        found = numbered.join(together, "#row").drop("#row")
    words = F.array_distinct(F.flatten(F.transform("#hit", lambda s: F.sequence(s["from"], s["to"] - 1))))
    found = found.withColumn("#n_hit", F.size(words).cast("long")) if slices > 1 else found.withColumn("#n_hit", F.aggregate("#hit", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"]))
    return (
        found.withColumn("#items", F.array_sort(F.array_distinct(F.transform("#matches", lambda m: m["item_id"]))))
        .withColumn("#contaminated", (F.col("#n_hit") > 0) & (20 * F.col("#n_hit") >= F.col("#n_words")))
        .drop("#hit")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return contamination(packed(docs), benchmark, window).where(~F.col("#contaminated")).select("row.*")


def op8_suffix_array_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("#n_words").alias("n_words"), F.col("#n_hit").alias("n_hit"), F.size("#items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "#items").cast("binary"), 256).alias("items_sha256"), F.col("#contaminated").alias("contaminated"),
    )
