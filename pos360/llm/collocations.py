"""Operator 13, phrase collocations from a weighted de Bruijn graph of words.

Nodes are sequences of three words, an edge of four words leads from its first
three to its last three, and its weight is how often the four words stand
together in a piece of text. Every word of a piece starts one edge; the last
three start a shorter one that ends with the piece (the piece-end corrections).
So one pass over the texts gives one weighted edge a word, summed up before
anything travels, and all shorter counts follow from the flow: three words occur
as often as the edges that leave them and the pieces that end with them weigh
together, two words as often as the nodes that begin with them, one word alike.

Edges travel to the bucket of their first two words, where their node's whole
flow is. Pairs that a bounded sample of the texts shows to be frequent are
spread by all four words instead, and their flow is summed over buckets; the
sample decides places only, never counts. Nodes all of whose flow comes by one
edge and leaves by one are inside a path (they are compacted): the longer
phrases say all that they could."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pos360.llm import textarrays as ta
from pos360.llm.tables import partitions, pieces, read_table, written

EDGE_WORDS = 4
MIN_COUNT = 30
TOP = 2000
COVER = (80, 100)  # a candidate goes if a longer one has this share of its count
BUCKET_BYTES = 8 << 20  # of text, whose edges make one bucket
GRAPH_BYTES = 4 << 20  # of text, whose edges are summed up before they travel
SAMPLE_BYTES = 64 << 20  # of text, in which frequent pairs are looked for
_U = np.uint64
_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _BREAKS.copy()
_BETWEEN[[0x20, 0x09]] = True
_LINES = np.zeros(256, bool)
_LINES[[0x20, 0x0A]] = True


class Words:
    """Words of texts, each with its hash and the number of words from it to its piece's end."""

    def __init__(self, column, lang: np.ndarray, lang_hash: np.ndarray) -> None:
        buf, off = ta.column_bytes(column)
        self.buf = ta.ASCII_LOWER[buf]
        self.start, self.end, at = ta.words(self.buf, off, _BETWEEN)
        n = len(self.start)
        self.hash = ta.hash_spans(self.buf, self.start, self.end)
        text = ta.row_of(at, n)
        self.lang = lang[text]
        self.lang_hash = lang_hash[self.lang]
        broken = np.zeros(len(self.buf) + 1, np.int64)
        np.cumsum(_BREAKS[self.buf], out=broken[1:])
        last = np.ones(n, bool)
        last[:-1] = (broken[self.start[1:]] != broken[self.end[:-1]]) | (text[1:] != text[:-1])
        ends = np.flatnonzero(last)
        self.left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1

    def pair_hash(self) -> np.ndarray:
        """Hash of each word with the next one of its piece, by language."""
        after = np.where(self.left > 1, np.append(self.hash[1:], _U(0)), _U(0)) if len(self.hash) else self.hash
        return ta.mix((self.hash ^ self.lang_hash) * _U(0x9E3779B97F4A7C15) + after)


def _languages(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    coded = batch["lang"].dictionary_encode()
    names = coded.dictionary.to_pylist()
    buf, off = ta.column_bytes(coded.dictionary)
    return names, coded.indices.to_numpy(), ta.hash_spans(buf, off[:-1], off[1:])


def _distinct(columns: list[np.ndarray], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an index of each distinct row of four numbers, rows in order, weight summed)."""
    a, b = ((columns[i] << 32) | columns[i + 1] for i in (0, 2))
    a, b = np.unique(a, return_inverse=True)[1], np.unique(b, return_inverse=True)[1]
    key = (a << 32) | b
    by = np.argsort(key, kind="stable")
    new = np.flatnonzero(np.r_[True, key[by][1:] != key[by][:-1]][: len(by)])
    return by[new], np.add.reduceat(weight[by], new) if len(new) else weight


def _lines(w: Words, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): a line for each run of n words from the first on, one space between."""
    word = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    size = w.end[word] - w.start[word] + 1
    to = np.zeros(len(word) + 1, np.int64)
    np.cumsum(size, out=to[1:])
    source = (np.arange(to[-1], dtype=np.int32) - np.repeat((to[:-1] - w.start[word]).astype(np.int32), size)) if to[-1] < 1 << 31 else (np.arange(to[-1]) - np.repeat(to[:-1] - w.start[word], size))
    out = w.buf[source]
    out[to[1:] - 1] = 0x20
    cut = np.zeros(len(n) + 1, np.int64)
    np.cumsum(n, out=cut[1:])
    out[to[cut[1:]] - 1] = 0x0A
    return out, to[cut]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def frequent_pairs(texts: DataFrame, buckets: int, text_bytes: int) -> np.ndarray:
    """Hashes of word pairs with over an eighth of a bucket's share of a sample of about SAMPLE_BYTES of text.

    There are at most 8 x buckets of them, and at most one for 64 of the sample's words."""
    share = max(1, text_bytes // SAMPLE_BYTES)
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches, size=GRAPH_BYTES):
            _, lang, lang_hash = _languages(b)
            pair, n = np.unique(Words(b["text"], lang, lang_hash).pair_hash(), return_counts=True)
            some = n >= max(2, n.sum() // (100 * buckets))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(pair[some].view(np.int64), 0)), pa.array(np.append(n[some], 0)), pa.array(np.append(np.zeros(some.sum(), np.int64), n.sum()))], ["pair", "n", "words"])

    counted = sample.mapInArrow(run, "pair long, n long, words long").groupBy("pair").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    counted = written(counted, "pairs")
    words = counted.agg(F.sum("words")).head()[0] or 0
    found = counted.where(F.col("n") >= max(64, words // (8 * buckets))).select("pair").collect()
    return np.sort(np.array([r["pair"] for r in found], np.int64).view(np.uint64))


def _is_in(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def edges(texts: DataFrame, buckets: int, spread: np.ndarray) -> DataFrame:
    """(lang, bucket, edges, weights): the graph of every GRAPH_BYTES of text, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in pieces(batches, size=GRAPH_BYTES):
            names, lang, lang_hash = _languages(b)
            w = Words(b["text"], lang, lang_hash)
            if not len(w.start):
                continue
            code = ta.span_codes(w.buf, w.start, w.end, w.hash)
            code = np.unique(w.lang * (int(code.max()) + 1) + code, return_inverse=True)[1] + 1
            padded = np.append(code, np.zeros(EDGE_WORDS, np.int64))
            nth = [np.where(w.left > i, padded[i : i + len(code)], 0) for i in range(EDGE_WORDS)]
            first, weight = _distinct(nth, np.ones(len(code), np.int64))
            n = np.minimum(w.left[first], EDGE_WORDS)
            place = w.pair_hash()[first]
            wide = _is_in(spread, place)
            rest = np.zeros(len(first), np.uint64)
            for i in range(2, EDGE_WORDS):
                rest = ta.mix(rest + np.where(n > i, w.hash[np.minimum(first + i, len(code) - 1)], _U(0)) + _U(i))
            bucket = (np.where(wide, place ^ rest, place) % _U(buckets)).astype(np.int64)
            key = w.lang[first].astype(np.int64) * buckets + bucket
            by = np.argsort(key, kind="stable")
            first, weight, n, key = first[by], weight[by], n[by], key[by]
            line, at = _lines(w, first, n)
            cut = np.append(np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key))
            yield pa.RecordBatch.from_arrays([
                pa.array([names[k // buckets] for k in key[cut[:-1]].tolist()], pa.string()),
                pa.array(key[cut[:-1]] % buckets, pa.int64()),
                pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(at[cut].astype(np.int64)), pa.py_buffer(line)]).cast(pa.binary()),
                pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(weight, pa.int64())),
            ], ["lang", "bucket", "edges", "weights"])

    return texts.mapInArrow(run, "lang string, bucket long, edges binary, weights array<long>")


def _flow(table: pa.Table, least: int, spread: np.ndarray) -> pa.Table:
    """Counts of the words, pairs, triples and fours that begin in one bucket.

    Fours are whole here, and so are pairs and triples but for the spread pairs;
    single words are parts. What is whole is left out below `least`."""
    lang = table["lang"][0].as_py()
    buf, _ = ta.column_bytes(table["edges"])
    start, end, _ = ta.words(buf, np.array([0, len(buf) - 8]), _LINES)
    ends = np.flatnonzero(buf[:-8] == 0x0A)
    cut = np.append(0, np.searchsorted(start, ends))
    weight = np.asarray(pa.chunked_array([c.flatten() for c in table["weights"].chunks]).combine_chunks(), np.int64)
    h = ta.hash_spans(buf, start, end)
    code = ta.span_codes(buf, start, end, h) + 1
    n, begin = np.diff(cut), cut[:-1]
    nth = [np.where(n > i, code[np.minimum(begin + i, len(code) - 1)], 0) for i in range(EDGE_WORDS)]
    one, weight = _distinct(nth, weight)
    nth, begin = [c[one] for c in nth], begin[one]
    after = np.where(n[one] > 1, h[np.minimum(begin + 1, len(h) - 1)], _U(0))
    lang_buf, lang_off = ta.column_bytes(pa.array([lang]))
    lang_hash = ta.hash_spans(lang_buf, lang_off[:-1], lang_off[1:])[0]
    wide = _is_in(spread, ta.mix((h[begin] ^ lang_hash) * _U(0x9E3779B97F4A7C15) + after))
    new = np.zeros(len(one), bool)
    new[:1] = True
    words, phrase, count = [], [], []
    data = buf.tobytes()
    for k in range(1, EDGE_WORDS + 1):
        # Distinct beginnings of k words are runs of the sorted edges; a run's weight is the flow.
        new[1:] |= nth[k - 1][1:] != nth[k - 1][:-1]
        runs = np.flatnonzero(new)
        flow = np.add.reduceat(weight, runs)
        keep = nth[k - 1][runs] > 0
        if k > 1:
            keep &= (flow >= least) | (wide[runs] & (k < EDGE_WORDS))
        runs = runs[keep]
        words.append(np.full(len(runs), k))
        count.append(flow[keep])
        phrase += [data[s:e].decode() for s, e in zip(start[begin[runs]].tolist(), end[begin[runs] + k - 1].tolist())]
    return pa.table({"lang": pa.array([lang] * len(phrase), pa.string()), "words": pa.array(np.concatenate(words), pa.int32()), "phrase": pa.array(phrase, pa.string()), "f": pa.array(np.concatenate(count), pa.int64())})


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of all phrases of 1 to 4 words with f >= least, (lang, n words in all))."""
    texts = _texts(docs)
    size = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(partitions(docs.sparkSession), -(-size // BUCKET_BYTES))
    spread = frequent_pairs(texts, buckets, size)

    def run(table: pa.Table) -> pa.Table:
        return _flow(table, least, spread)

    parts = written(edges(texts, buckets, spread).groupBy("lang", "bucket").applyInArrow(run, "lang string, words int, phrase string, f long"), "flow")
    total = parts.where("words = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    whole = parts.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return written(whole, "phrases"), total


def _part(words: Column, start: int, n: int) -> Column:
    return F.array_join(F.slice(words, start + 1, n), " ")


def compact(phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(phrases without those inside unary paths, (lang, phrase) of the nodes inside).

    A node is inside where an edge of its own count leads to it and one leads away:
    then these are its only ones, and no piece begins or ends there."""
    nodes, long = phrases.where(F.col("words") == EDGE_WORDS - 1), phrases.where(F.col("words") == EDGE_WORDS)
    words = F.split("phrase", " ")
    ends = long.select("lang", "f", F.explode(F.array(*(F.struct(F.lit(i).alias("side"), _part(words, i, EDGE_WORDS - 1).alias("phrase")) for i in (0, 1)))).alias("e")).select("lang", "f", "e.*")
    sides = ends.groupBy("lang", "phrase", "f").agg(F.count_distinct("side").alias("sides")).where("sides = 2").select("lang", "phrase", "f")
    inside = nodes.join(sides, ["lang", "phrase", "f"]).select("lang", "phrase")
    return phrases.join(inside, ["lang", "phrase"], "left_anti"), inside


def paths(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, words, f): the edges, joined to one phrase along their unary paths.

    Each round doubles the part of a path that an edge knows; the parts are
    written, so the rounds are the logarithm of the longest path."""
    _, inside = compact(phrases)
    words = F.split("phrase", " ")
    edge = phrases.where(F.col("words") == EDGE_WORDS).select("lang", "f", "phrase", _part(words, 0, EDGE_WORDS - 1).alias("tail"), _part(words, 1, EDGE_WORDS - 1).alias("head"))
    joined = inside.select(F.col("lang").alias("l"), F.col("phrase").alias("node"))
    open_head = edge.join(joined, (F.col("lang") == F.col("l")) & (F.col("head") == F.col("node")), "left").select("lang", "f", "phrase", "tail", F.when(F.col("node").isNotNull(), F.col("head")).alias("head"))
    starts = open_head.join(joined, (F.col("lang") == F.col("l")) & (F.col("tail") == F.col("node")), "left").select("lang", "f", "phrase", "tail", "head", F.col("node").isNull().alias("first"))
    known = written(starts, "paths")
    while not known.where("head is not null").isEmpty():
        on = known.select(F.col("lang").alias("l"), F.col("tail").alias("t"), F.col("phrase").alias("more"), F.col("head").alias("next"))
        grown = known.join(on, (F.col("lang") == F.col("l")) & (F.col("head") == F.col("t")), "left")
        rest = F.array_join(F.slice(F.split("more", " "), EDGE_WORDS, F.size(F.split("more", " "))), " ")
        known = written(grown.select("lang", "f", F.when(F.col("more").isNull(), F.col("phrase")).otherwise(F.concat_ws(" ", "phrase", rest)).alias("phrase"), "tail", F.col("next").alias("head"), "first"), "paths")
    return known.where("first").select("lang", "phrase", F.size(words).alias("words"), "f")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first `top` phrases of 2 to 4 words.

    Defined cases: null texts have no words, a null lang is `und`; document ids
    play no part, so repeated, null ids and equal rows all count; texts of any
    length are cut into pieces whole; equal scores go by count, then by the
    phrase's bytes; an empty table gives no rows; other columns do not matter."""
    phrases, total = phrase_counts(docs, least)
    words = F.split("phrase", " ")
    longer = phrases.where(F.col("words") > 2)
    parts = [(n, i, k) for n in range(3, EDGE_WORDS + 1) for k in range(2, n) for i in range(n - k + 1)]
    inner = F.filter(F.array(*(F.when(F.col("words") == n, _part(words, i, k)) for n, i, k in parts)), lambda x: x.isNotNull())
    cover = longer.select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("covers"))
    outside, _ = compact(phrases.where("words > 1"))
    share, whole = COVER
    candidates = outside.join(cover, ["lang", "phrase"], "left").where(F.col("covers").isNull() | (whole * F.col("covers").cast("decimal(20,0)") < share * F.col("f").cast("decimal(20,0)")))
    cuts = F.filter(F.array(*(F.when(F.col("words") > k, F.struct(F.lit(k).alias("k"), _part(words, 0, k).alias("left"), F.array_join(F.slice(words, k + 1, EDGE_WORDS), " ").alias("right"))) for k in range(1, EDGE_WORDS))), lambda x: x.isNotNull())
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.*")
    counts = phrases.where(F.col("words") < EDGE_WORDS)
    scored = cut.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000BD) div (cast(l as decimal(20,0)) + r)")
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.select("lang", "phrase", "a", "cut.*").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_debruijn_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))
