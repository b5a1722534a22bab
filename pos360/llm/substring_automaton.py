"""Operator 6, substring dedup: suffix automata of reference shards.

The reference is the corpus itself, in shards by anchor (see passages.py). A
shard's passages arrive in document order; each streams through the suffix
automaton of all that came before, whose matching statistics give the longest
earlier match that ends at every word, and is then added to it. Words under a
match of at least the window length go.

All automata together grow with the corpus, so none is broadcast: each stays in
the task that owns its shard, and the passages that can match there come to it.
An automaton is bounded by its shard's distinct passages."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pos360.llm import passages as ps
from pos360.llm.tables import read_table
from pos360.llm.textarrays import mark_runs

WINDOW_WORDS = 20
ANCHOR_WORDS = 8


class SuffixAutomaton:
    """All substrings of the added sequences (Blumer et al. 1985, for several sequences)."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, arrows: dict, link: int) -> int:
        self.next.append(arrows)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _target(self, at: int, symbol) -> int:
        """State that holds exactly the strings reached from `at`, split off where it holds longer ones."""
        there = self.next[at][symbol]
        if self.length[there] == self.length[at] + 1:
            return there
        half = self._state(self.length[at] + 1, dict(self.next[there]), self.link[there])
        self.link[there] = half
        while at >= 0 and self.next[at].get(symbol) == there:
            self.next[at][symbol] = half
            at = self.link[at]
        return half

    def add(self, symbols: Sequence) -> None:
        last = 0
        for x in symbols:
            if x in self.next[last]:
                last = self._target(last, x)
                continue
            new, at = self._state(self.length[last] + 1, {}, 0), last
            while at >= 0 and x not in self.next[at]:
                self.next[at][x] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._target(at, x)
            last = new

    def matching(self, symbols: Sequence) -> Iterator[int]:
        """Length of the longest added substring that ends at each symbol."""
        arrows, link, length = self.next, self.link, self.length
        at = n = 0
        for x in symbols:
            while at and x not in arrows[at]:
                at = link[at]
                n = length[at]
            if x in arrows[at]:
                at = arrows[at][x]
                n += 1
            else:
                n = 0
            yield n


def judge_shard(window: int):
    def judge(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        blocks, metas, contents = [], [], []
        for block, meta, content in zip(table["block"].to_pylist(), table["meta"].to_pylist(), table["content"].to_pylist()):
            m = np.frombuffer(meta, ps.META)
            ends = np.cumsum(m["bytes"].astype(np.int64))
            blocks.append(np.full(len(m), block))
            metas.append(m)
            contents += [content[b - n : b] for b, n in zip(ends.tolist(), m["bytes"].tolist())]
        block, meta = np.concatenate(blocks), np.concatenate(metas)
        by = np.lexsort((meta["region"], meta["pos"], meta["order"]))
        bits = np.zeros(len(meta), np.uint64)
        names: dict[bytes, int] = {}
        automaton = SuffixAutomaton()
        orders, positions = meta["order"].tolist(), meta["pos"].tolist()
        for _, group in groupby(by.tolist(), key=orders.__getitem__):
            own: dict[tuple, int] = {}  # first start of this document's windows that no earlier document has
            found = []
            for i in group:
                seq = [names.setdefault(w, len(names)) for w in contents[i].split(b" ")]
                flags = 0
                for end, n in enumerate(automaton.matching(seq), 1):
                    if n >= window:
                        flags |= 1 << (end - window)
                    elif end >= window:
                        own.setdefault(tuple(seq[end - window : end]), positions[i] + end - window)
                found.append((i, seq, flags))
            for i, seq, flags in found:
                n = len(seq) - window + 1
                if flags != (1 << n) - 1:
                    automaton.add(seq)
                    for start in range(n):
                        if not flags >> start & 1 and own[tuple(seq[start : start + window])] < positions[i] + start:
                            flags |= 1 << start
                bits[i] = flags
        answer = np.empty(len(meta), ps.ANSWER)
        answer["region"], answer["bits"] = meta["region"], bits
        for one in np.unique(block):
            mine = answer[block == one]
            yield int(one), mine[mine["bits"] != 0]

    return judge


def dedup_words(docs: DataFrame, window: int = WINDOW_WORDS, *, keep_rest: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, spans (maximal runs of
    removed words), and kept (the words left, joined by a space).

    A word goes if some window of `window` words that covers it also starts
    earlier: in a document with a smaller id, or earlier in the same document.
    Defined cases: null text has no words; a text shorter than the window stays;
    a null id counts as smaller than any other; rows that share an id are one
    document whose starts are compared, so equal rows get equal results; an
    empty table gives no row; other columns do not matter."""
    k = ps.anchor_length(window, ANCHOR_WORDS)
    rule = ps.Rule(window, k, True, ps.word_symbols(k))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<from:long,to:long>>, kept string"
    if keep_rest:
        schema = T.StructType([*T.StructType.fromDDL(schema), T.StructField("rest", T.StructType([f for f in docs.schema if f.name != "text"]))])

    def finish(left: pa.Table, windows: list[np.ndarray], s: ps.Symbols) -> pa.Table:
        out = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "spans", "kept")}
        for i, w in enumerate(windows):
            a, b = int(s.offsets[i]), int(s.offsets[i + 1])
            spans, n_removed = [], 0
            if len(w):
                gone = mark_runs(b - a, w, w + window)
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                spans = [{"from": x, "to": y} for x, y in edge.reshape(-1, 2).tolist()]
                n_removed = int(gone.sum())
                rest = np.flatnonzero(~gone) + a
                kept = b" ".join(s.buf[x:y].tobytes() for x, y in zip(s.start[rest].tolist(), s.end[rest].tolist()))
            else:
                kept = s.buf[s.start[a] : s.end[b - 1]].tobytes() if b > a else b""
            for k, v in (("n_words", b - a), ("n_removed", n_removed), ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("spans", spans), ("kept", kept)):
                out[k].append(v)
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        table = {"doc_id": pa.array([None if x == ps.FIRST else x for x in left["order"].to_pylist()], pa.int64())}
        table |= {k: pa.array(out[k], pa.int64()) for k in ("n_words", "n_removed")}
        table |= {"kept_sha256": pa.array(out["kept_sha256"], pa.string()), "spans": pa.array(out["spans"], span), "kept": pa.array(out["kept"], pa.binary()).cast(pa.string())}
        if keep_rest:
            table["rest"] = left["rest"]
        return pa.table(table)

    return ps.repeated_passages(docs, rule, judge_shard(window), finish, schema)


def op6_suffix_automata_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_words(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
