"""Operator 1, suffix-array dedup: a logarithmic family of suffix arrays.

Texts are indexed in batches, in the order of their ids. A batch's suffixes are
sorted (to the depth that a match needs), scanned in one merge against every
level that is already there, for matches of the full length, and become a level
of size one. Two levels of equal size are merged into one of twice the size, as
in a binary counter, so a suffix is rewritten log2(batches) times.

The family is sharded: each task keeps the levels of the suffixes whose anchor
(see passages.py) falls to it, over all batches. Only suffixes in passages
whose anchor occurs in two documents are indexed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pos360.llm import passages as ps
from pos360.llm.tables import read_table
from pos360.llm.textarrays import mark_runs

MATCH_BYTES = 50
ANCHOR_BYTES = 24
BATCHES = 16  # of a shard; the levels number log2 of it at most


class Levels:
    """Sorted suffixes with the smallest id that has each, in levels of doubling size."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []  # (batches, suffixes, smallest id)

    def scan(self, suffixes: np.ndarray) -> np.ndarray:
        """Smallest id in the index of each of the sorted suffixes (the largest long: none)."""
        least = np.full(len(suffixes), np.iinfo(np.int64).max)
        for _, known, ids in self.levels:
            at = np.minimum(np.searchsorted(known, suffixes), len(known) - 1)
            hit = known[at] == suffixes
            least[hit] = np.minimum(least[hit], ids[at[hit]])
        return least

    def add(self, suffixes: np.ndarray, ids: np.ndarray) -> None:
        """A batch's distinct sorted suffixes; equal levels merge, equal suffixes keep the smallest id."""
        if not len(suffixes):
            return
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, known, known_ids = self.levels.pop()
            at = np.searchsorted(known, suffixes)
            inside = np.minimum(at, len(known) - 1)
            both = known[inside] == suffixes
            known_ids = known_ids.copy()
            known_ids[inside[both]] = np.minimum(known_ids[inside[both]], ids[both])
            suffixes = np.insert(known, at[~both], suffixes[~both])
            ids = np.insert(known_ids, at[~both], ids[~both])
            size *= 2
        self.levels.append((size, suffixes, ids))


def suffixes_of(meta: np.ndarray, content: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes cut to the length, their region, their window) of packed regions."""
    n = meta["n"].astype(np.int64)
    base = np.append(0, np.cumsum(meta["bytes"].astype(np.int64))[:-1])
    region = np.repeat(np.arange(len(meta)), n)
    window = np.arange(n.sum()) - np.repeat(np.append(0, np.cumsum(n)[:-1]), n)
    rows = np.lib.stride_tricks.sliding_window_view(content, length)[base[region] + window]
    return np.ascontiguousarray(rows).view(f"V{length}").ravel().view(f"S{length}"), region, window


def judge_shard(length: int, batches: int):
    def judge(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(np.asarray(table["block"]), kind="stable")
        family = Levels()
        for part in np.array_split(order, min(batches, len(order))):
            blocks = np.asarray(table["block"])[part]
            metas = [np.frombuffer(table["meta"][int(i)].as_py(), ps.META) for i in part]
            meta = np.concatenate(metas)
            content = np.frombuffer(b"".join(table["content"][int(i)].as_py() for i in part), np.uint8)
            suffix, region, window = suffixes_of(meta, content, length)
            sa = np.argsort(suffix, kind="stable")
            run = suffix[sa]
            new = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            group = np.cumsum(np.r_[False, run[1:] != run[:-1]])
            ids = meta["order"][region[sa]]
            least = np.minimum.reduceat(ids, new)
            earlier = family.scan(run[new])
            family.add(run[new], least)
            repeated = np.minimum(least, earlier)[group] < ids
            bits = np.zeros(len(meta), np.uint64)
            np.bitwise_or.at(bits, region[sa[repeated]], np.uint64(1) << window[sa[repeated]].astype(np.uint64))
            answer = np.empty(len(meta), ps.ANSWER)
            answer["region"], answer["bits"] = meta["region"], bits
            for block, a in zip(blocks.tolist(), np.split(answer, np.cumsum([len(m) for m in metas])[:-1])):
                yield block, a[a["bits"] != 0]

    return judge


def dedup_bytes(docs: DataFrame, length: int = MATCH_BYTES, *, keep_rest: bool = False, batches: int = BATCHES) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept (the
    bytes left, joined) and kept_text (these as text, without the pieces of
    characters that a removal cut); with keep_rest the other columns come in a
    struct `rest`.

    A byte goes if some string of `length` bytes that covers it also starts in a
    document with a smaller id. Defined cases: null text is empty; a text
    shorter than `length` stays; a null id counts as smaller than any other;
    rows that share an id are one document to the rule, each judged by itself;
    copies of any number collapse to one region per block; an empty table gives
    no row; other columns do not matter, whatever their names. `length` is 8 at
    least."""
    k = ps.anchor_length(length, ANCHOR_BYTES, 8)
    rule = ps.Rule(length, k, False, ps.byte_symbols(k))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<from:long,to:long>>, kept binary, kept_text string"
    if keep_rest:
        schema = T.StructType([*T.StructType.fromDDL(schema), T.StructField("rest", T.StructType([f for f in docs.schema if f.name != "text"]))])

    def finish(left: pa.Table, windows: list[np.ndarray], s: ps.Symbols) -> pa.Table:
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
        for i, w in enumerate(windows):
            text = s.buf[s.offsets[i] : s.offsets[i + 1]]
            kept, spans = text.tobytes(), []
            if len(w):
                gone = mark_runs(len(text), w, w + length)
                edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                spans = [{"from": a, "to": b} for a, b in edge.reshape(-1, 2).tolist()]
                kept = text[~gone].tobytes()
            for k, v in (("n_bytes", len(text)), ("n_removed", len(text) - len(kept)), ("n_spans", len(spans)), ("kept_sha256", hashlib.sha256(kept).hexdigest()), ("spans", spans), ("kept", kept)):
                out[k].append(v)
        order = left["order"].to_pylist()
        span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        table = {"doc_id": pa.array([None if x == ps.FIRST else x for x in order], pa.int64())}
        table |= {k: pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")}
        table |= {"kept_sha256": pa.array(out["kept_sha256"], pa.string()), "spans": pa.array(out["spans"], span), "kept": pa.array(out["kept"], pa.binary())}
        table["kept_text"] = pa.array([k.decode("utf-8", "ignore") for k in out["kept"]], pa.string())
        if keep_rest:
            table["rest"] = left["rest"]
        return pa.table(table)

    return ps.repeated_passages(docs, rule, judge_shard(length, batches), finish, schema)


def op1_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
