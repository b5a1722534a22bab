"""Operator 5, SentencePiece encoding and decoding with the unigram model.

The pieces of a public model file and their scores, taken as log scores, go
into a double-array trie. Of all ways to write a text in pieces the Viterbi
path with the largest sum of scores is taken; characters that no piece covers
fall back to byte pieces. Decoding turns the whitespace marker back into spaces
and byte pieces into bytes.

A text's path falls apart where a marker follows another character, unless a
piece spans such a place (checked when the model is read), so segments between
these places are encoded once for all their occurrences in a task. A long
segment is cut further between two characters that stand side by side in no
piece, and what is still long is worked off in windows: a window's path is final
up to the last place where the paths to all its possible ends agree."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pos360.llm import textarrays as ta
from pos360.llm.tables import packed, pieces, read_table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNKNOWN_PENALTY = 10.0
CACHE_BYTES = 24 << 20  # of segments and ids that a task keeps; a full cache is emptied
_ENTRY_BYTES = 180  # of a kept segment, besides its own
PART_BYTES = 1 << 18  # of new segments that are encoded at a time
CHUNK_BYTES = 1 << 20  # of a long text that is taken apart at a time
LONG_BYTES = 64  # segments from here on are cut between characters
WINDOW_BYTES = 1 << 13
_LOCKSTEP_BYTES = 256  # longer segments are walked one by one


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[i] & 127) << shift
        shift += 7
        i += 1
        if data[i - 1] < 128:
            return value, i


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a serialised message's fields."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        if key & 7 == 0:
            value, i = _varint(data, i)
        else:
            n, i = (8, i) if key & 7 == 1 else (4, i) if key & 7 == 5 else _varint(data, i)
            value, i = data[i : i + n], i + n
            if key & 7 == 5:
                value = struct.unpack("<f", value)[0]
        yield key >> 3, value


class DoubleArray:
    """Trie over bytes: from state s the byte c leads to t = base[s] + c if check[t] is s."""

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        tree: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, value in zip(keys, values):
            at = 0
            for c in key:
                if c not in tree[at]:
                    tree[at][c] = len(tree)
                    tree.append({})
                    ends.append(-1)
                at = tree[at][c]
            ends[at] = value
        size = 4 * len(tree) + 1024
        used = np.zeros(size, bool)
        used[0] = True
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        place = {0: 0}
        # Where to look next for a node of so many arrows: what lies before was full for it.
        begin: dict[int, int] = {}
        for node, arrows in enumerate(tree):
            s = place.pop(node)
            value[s] = ends[node]
            if not arrows:
                continue
            codes = sorted(arrows)
            b = begin.get(len(codes), 1)
            while True:
                if b + 1024 + 256 >= size:
                    used, base = np.append(used, np.zeros(size, bool)), np.append(base, np.zeros(size, np.int32))
                    check, value = (np.append(x, np.full(size, -1, np.int32)) for x in (check, value))
                    size *= 2
                taken = used[b + codes[0] : b + codes[0] + 1024].copy()
                for c in codes[1:]:
                    taken |= used[b + c : b + c + 1024]
                fit = int(np.argmin(taken))
                if not taken[fit]:
                    break
                b += 1024
            begin[len(codes)] = b
            b += fit
            base[s] = b
            at = b + np.array(codes)
            used[at], check[at] = True, s
            for c in codes:
                place[arrows[c]] = b + c
        self.base, self.check, self.value = base, check, value


class PieceModel:
    """Pieces of a SentencePiece model file, for unigram encoding."""

    def __init__(self, data: bytes) -> None:
        pieces, self.dummy_prefix, charsmap = [], True, b""
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append((piece.get(1, b""), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif number == 3:
                normalizer = dict(_fields(value))
                charsmap, self.dummy_prefix = normalizer.get(2, b""), bool(normalizer.get(3, 1))
                if charsmap or normalizer.get(4, 1):
                    raise ValueError("models that rewrite characters or drop white space are not supported")
        self.kinds = np.array([k for _, _, k in pieces])
        normal = [s for _, s, k in pieces if k == NORMAL]
        top, self.unknown_score = max(normal), min(normal) - UNKNOWN_PENALTY
        score = [0.1 * -1 + len(p.decode()) * top if k == USER else s for p, s, k in pieces]
        self.score = np.array([*score, self.unknown_score])
        self.unknown = len(pieces)  # stands for an uncovered character until its bytes are written
        in_trie = [i for i, (p, _, k) in enumerate(pieces) if k in (NORMAL, USER) and p]
        self.trie = DoubleArray([pieces[i][0] for i in in_trie], in_trie)
        self.byte_piece = np.full(256, int(np.flatnonzero(self.kinds == UNKNOWN)[0]), np.int32)
        text = []
        for i, (p, _, k) in enumerate(pieces):
            if k == BYTE:
                self.byte_piece[int(p[3:-1], 16)] = i
                text.append(bytes([int(p[3:-1], 16)]))
            else:
                text.append(b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, b" "))
        self.text_at = np.zeros(len(text) + 1, np.int64)
        np.cumsum([len(t) for t in text], out=self.text_at[1:])
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.longest = max(len(pieces[i][0]) for i in in_trie)
        inner = [np.frombuffer(pieces[i][0].replace(MARK, b" ").decode().encode("utf-32-le"), np.uint32).astype(np.int64) for i in in_trie]
        self.pairs = np.unique(np.concatenate([(p[:-1] << 21) | p[1:] for p in inner]))
        crosses = any(re.search(b"[^ ] ", pieces[i][0].replace(MARK, b" ")) for i in in_trie)
        self.segment = re.compile(b".+" if crosses else b" *[^ ]+| +", re.DOTALL)

    def _edges(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every piece that matches in the segments, and of uncovered characters."""
        n = int(off[-1])
        end_of = off[1:][ta.row_of(off, n)]
        start = np.flatnonzero((buf[:n] & 0xC0) != 0x80)
        width = np.diff(np.append(start, n))
        starts, ends, ids = [], [], []
        single = np.zeros(len(start), bool)
        live, node, depth = np.arange(len(start)), np.zeros(len(start), np.int64), 0
        while len(live):
            at = start[live] + depth
            inside = at < end_of[start[live]]
            live, node, at = live[inside], node[inside], at[inside]
            to = self.trie.base[node] + buf[at].astype(np.int64)
            ok = self.trie.check[to] == node
            live, node = live[ok], to[ok]
            depth += 1
            hit = np.flatnonzero(self.trie.value[node] >= 0)
            starts.append(start[live[hit]])
            ends.append(start[live[hit]] + depth)
            ids.append(self.trie.value[node[hit]].astype(np.int64))
            single[live[hit[width[live[hit]] == depth]]] = True
        alone = np.flatnonzero(~single)
        starts.append(start[alone])
        ends.append(start[alone] + width[alone])
        ids.append(np.full(len(alone), self.unknown))
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(ids)

    def _best(self, marked: list[bytes], off: np.ndarray) -> tuple[np.ndarray, ...]:
        """(buffer, start, end, piece, first, back): edges, whether one begins its segment, and the last edge of the best path to each place."""
        buf = np.frombuffer(b"".join(marked), np.uint8)
        start, end, piece = self._edges(buf, off)
        segment = np.searchsorted(off, start, "right") - 1
        size = np.diff(off)
        best, back = np.full(int(off[-1]) + 1, -np.inf), np.full(int(off[-1]) + 1, -1, np.int64)
        # Position 0 of a segment is the end of the one before: paths never meet there, as starts read 0 instead.
        score = self.score[piece]
        first = start == off[segment]
        short = size[segment] <= _LOCKSTEP_BYTES
        reach = end - off[segment]
        by = np.lexsort((start, end, np.where(short, reach, _LOCKSTEP_BYTES + 1)))
        start, end, piece, score, first = start[by], end[by], piece[by], score[by], first[by]
        n_short = int(short.sum())
        cuts = np.flatnonzero(np.r_[True, np.diff(reach[by][:n_short]) != 0]) if n_short else np.zeros(0, np.int64)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), n_short]):
            sums = np.where(first[a:b], 0.0, best[start[a:b]]) + score[a:b]
            new = np.flatnonzero(np.r_[True, end[a + 1 : b] != end[a : b - 1]])
            most = np.maximum.reduceat(sums, new)
            winner = np.flatnonzero(sums == np.repeat(most, np.diff(np.append(new, b - a))))
            to = end[a:b][winner]
            lead = np.r_[True, to[1:] != to[:-1]]  # of equal sums the earliest start, as edges are in order of it
            best[to[lead]], back[to[lead]] = most, winner[lead] + a
        for i, (s, e, x, f) in enumerate(zip(start[n_short:].tolist(), end[n_short:].tolist(), score[n_short:].tolist(), first[n_short:].tolist()), n_short):
            total = (0.0 if f else best[s]) + x
            if back[e] < 0 or total > best[e]:
                best[e], back[e] = total, i
        return buf, start, end, piece, first, back

    def _ids(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray, piece: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the edges in turn, ids of each edge): an uncovered character has one for each byte."""
        uncovered = piece[edge] == self.unknown
        n = np.where(uncovered, end[edge] - start[edge], 1)
        index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        source = np.repeat(edge, n)
        byte = self.byte_piece[buf[np.minimum(start[source] + index, len(buf) - 1)]]
        return np.where(np.repeat(uncovered, n), byte, np.minimum(piece[source], self.unknown - 1)).astype(np.int32), n

    def encode_segments(self, segments: list[bytes]) -> list[bytes]:
        """Piece ids of each segment (spaces stand for the marker), as 32-bit numbers."""
        marked = [s.replace(b" ", MARK) for s in segments]
        off = np.zeros(len(marked) + 1, np.int64)
        np.cumsum([len(s) for s in marked], out=off[1:])
        buf, start, end, piece, first, back = self._best(marked, off)
        size = np.diff(off)
        # Walk back from all segment ends at once.
        who, at = np.flatnonzero(size > 0), off[1:][size > 0]
        owners, edges = [], []
        while len(who):
            edge = back[at]
            owners.append(who)
            edges.append(edge)
            go = ~first[edge]
            who, at = who[go], start[edge[go]]
        if not owners:
            return [b"" for _ in segments]
        owner, edge = np.concatenate(owners[::-1]), np.concatenate(edges[::-1])
        by = np.argsort(owner, kind="stable")
        owner, edge = owner[by], edge[by]
        ids, n = self._ids(buf, start, end, piece, edge)
        cut = (4 * np.searchsorted(np.repeat(owner, n), np.arange(len(segments) + 1))).tolist()
        ids = ids.tobytes()
        return [ids[a:b] for a, b in zip(cut[:-1], cut[1:])]

    def cut(self, segment: bytes) -> Iterator[bytes]:
        """The segment between the places that no piece spans: its paths meet there."""
        try:
            text = segment.decode()
        except UnicodeDecodeError:
            yield segment
            return
        begin = 0
        for a in range(1, len(text), CHUNK_BYTES):
            c = np.frombuffer(text[a - 1 : a + CHUNK_BYTES].encode("utf-32-le"), np.uint32).astype(np.int64)
            pair = (c[:-1] << 21) | c[1:]
            known = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
            for e in (np.flatnonzero(~known) + a).tolist():
                yield text[begin:e].encode()
                begin = e
        yield text[begin:].encode()

    def encode_long(self, segment: bytes) -> bytes:
        """Piece ids of one long segment, in windows: memory does not grow with the segment."""
        text, out, window, at = segment.replace(b" ", MARK), [], WINDOW_BYTES, 0
        while at < len(text):
            end = min(len(text), at + window)
            while end < len(text) and text[end] & 0xC0 == 0x80:
                end -= 1
            if end == len(text):
                out.append(self.encode_segments([text[at:]])[0])
                break
            ids, done = self._encode_open(text[at:end])
            out.append(ids)
            at, window = at + done, WINDOW_BYTES if done else 2 * window
        return b"".join(out)

    def _encode_open(self, text: bytes) -> tuple[bytes, int]:
        """(ids, bytes) of the part of a window that is final, whatever follows the window.

        A path leaves the window from one of its last places, not further from
        its end than the longest piece; what the best paths to all of them share is final."""
        n = len(text)
        buf, start, end, piece, first, back = self._best([text], np.array([0, n]))
        places = {p for p in range(max(1, n - self.longest), n + 1) if back[p] >= 0}
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            places.add(0 if first[back[last]] else int(start[back[last]]))
        (done,) = places
        edges, at = [], done
        while at:
            edges.append(back[at])
            at = 0 if first[back[at]] else start[back[at]]
        edge = np.array(edges[::-1], np.int64)
        return self._ids(buf, start, end, piece, edge)[0].tobytes(), done

    def _known(self, segments: list[bytes], cache: dict[bytes, bytes]) -> bytes:
        """Piece ids of the segments one after the other; what the cache lacks is encoded and kept."""
        fresh = list({s for s in segments if s not in cache})
        kept = cache.get(b"", 0)  # bytes in the cache; no segment is empty
        new = sum(map(len, fresh)) * 3 + len(fresh) * _ENTRY_BYTES
        if kept + new > CACHE_BYTES:
            cache.clear()
            fresh, kept = list(set(segments)), 0
            new = sum(map(len, fresh)) * 3 + len(fresh) * _ENTRY_BYTES
        cache[b""] = kept + new
        part, size = [], 0
        for s in fresh:
            if len(s) > WINDOW_BYTES:
                cache[s] = self.encode_long(s)
                continue
            part.append(s)
            size += len(s)
            if size >= PART_BYTES:
                cache.update(zip(part, self.encode_segments(part)))
                part, size = [], 0
        if part:
            cache.update(zip(part, self.encode_segments(part)))
        return b"".join([cache[s] for s in segments])

    def _segments(self, text: bytes) -> Iterator[list[bytes]]:
        """The text's segments, in lists of about CHUNK_BYTES at most."""
        text = (b" " if self.dummy_prefix else b"") + text.replace(MARK, b" ")
        found = [self.segment.findall(text)] if len(text) <= CHUNK_BYTES else ([m[0]] for m in self.segment.finditer(text))
        for some in found:
            if max(map(len, some), default=0) <= LONG_BYTES:
                yield some
            else:
                for s in some:
                    if len(s) <= LONG_BYTES:
                        yield [s]
                    else:
                        yield from ([x] for x in self.cut(s))

    def encode(self, texts: list[bytes], cache: dict[bytes, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids of all texts, offsets). Segments are looked up in, and added to, the cache.

        Several texts are taken together up to CHUNK_BYTES; a longer one is worked off in chunks."""
        out, n = [], np.zeros(len(texts), np.int64)
        todo: list[bytes] = []
        ends: list[tuple[int, int]] = []  # (text, segments of it) in todo
        size = 0

        def flush() -> None:
            nonlocal size
            first = 0
            out.append(self._known(todo, cache))
            for t, count in ends:
                n[t] += sum(len(cache[s]) for s in todo[first : first + count]) // 4
                first += count
            todo.clear()
            ends.clear()
            size = 0

        for t, text in enumerate(texts):
            before = len(todo)
            if text:
                for some in self._segments(text):
                    todo += some
                    size += len(text) if len(some) > 1 else sum(map(len, some))
                    if size >= CHUNK_BYTES:
                        ends.append((t, len(todo) - before))
                        flush()
                        before = 0
            ends.append((t, len(todo) - before))
        flush()
        at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(n, out=at[1:])
        return np.frombuffer(b"".join(out), np.int32), at

    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Texts of the pieces: markers become spaces, the dummy prefix goes, byte pieces become bytes."""
        lines, ends = [], np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.text_at[ids + 1] - self.text_at[ids], out=ends[1:])
        for a in range(0, len(ids), CHUNK_BYTES // 4):
            some = ids[a : a + CHUNK_BYTES // 4]
            size = self.text_at[some + 1] - self.text_at[some]
            index = np.arange(size.sum()) + np.repeat(self.text_at[some] - (np.cumsum(size) - size), size)
            lines.append(self.text[index].tobytes())
        line, cuts = b"".join(lines), ends[at].tolist()
        out = [line[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return [t[1:] if self.dummy_prefix and t[:1] == b" " else t for t in out]


def read_model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel(f.read())


def encode_texts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """docs with `n_tokens`, `ids` (piece ids of the whole text) and `round_trip`
    (decoding the ids gives the text), in place of columns of these names.

    Defined cases: null and empty texts have no pieces and count as a round
    trip; a text that holds the whitespace marker itself decodes to spaces and
    is the one case without round trip; null or repeated ids, equal rows and
    other columns pass through; an empty table gives no row. The model file is
    read on the driver and sent to the tasks; its size is that of the vocabulary."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_model(model))
    docs = docs.drop("n_tokens", "ids", "round_trip")
    rows = packed(docs).select("row", F.col("text").cast("binary").alias("bytes"))
    names = docs.columns
    schema = T.StructType(list(docs.schema)).add("n_tokens", "long").add("ids", T.ArrayType(T.IntegerType())).add("round_trip", "boolean")

    def run(batches: Iterator[pa.RecordBatch]):
        coder, cache = shared.value, {}
        for b in pieces(batches, "bytes"):
            texts = b["bytes"].to_pylist()
            ids, at = coder.encode(texts, cache)
            same = [x == y for x, y in zip(coder.decode(ids, at), texts)]
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            own = b["row"].flatten()
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(at), pa.int64()), lists, pa.array(same, pa.bool_())], [*names, "n_tokens", "ids", "round_trip"])

    return rows.mapInArrow(run, schema)


def decode_ids(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """tokens with `text`, decoded from `ids` (null ids: null text; bytes that are not UTF-8 become U+FFFD)."""
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast(read_model(model))
    tokens = tokens.drop("text")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            lists = [x or [] for x in b["ids"].to_pylist()]
            at = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int64)
            flat = np.array([i for x in lists for i in x], np.int64)
            text = [t.decode("utf-8", "replace") for t in shared.value.decode(flat, at)]
            null = np.asarray(b["ids"].is_null())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([None if n else t for n, t in zip(null, text)], pa.string())], [*b.schema.names, "text"])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema, T.StructField("text", T.StringType())]))


def op5_sentencepiece_unigram(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return encode_texts(docs).drop("text")
