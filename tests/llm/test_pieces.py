"""Operator 5 against the reference library's lattice, brute force and exact round trips."""

import random
import tracemalloc

import numpy as np
import pytest
import sentencepiece

from corpus import DOCS, rows, texts
from pos360.llm import sentencepiece_codec as sc


@pytest.fixture(scope="module")
def model():
    return sc.read_model(sc.MODEL)


def encode(model, found):
    ids, at = model.encode([t.encode() for t in found], {})
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def unigram_library():
    """The library over the same pieces, told to treat their scores as a unigram model's."""
    with open(sc.MODEL, "rb") as f:
        data = f.read()
    i, out = 0, b""
    while i < len(data):
        start = i
        key, i = sc._varint(data, i)
        n, i = sc._varint(data, i)
        body, i = data[i : i + n], i + n
        if key >> 3 == 2:  # trainer settings; field 3 is the model type
            kept = body.replace(b"\x18\x02", b"\x18\x01", 1)
            assert len(kept) == len(body) and dict(sc._fields(kept))[3] == 1
            out += data[start : i - n] + kept
        else:
            out += data[start:i]
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def test_words_match_the_library(model):
    library = unigram_library()
    rng = random.Random(1)
    found = ["the", "hello", "naïve", "日本", "x😀y", "a" * 40, "don't", "  two  spaces"]
    found += ["".join(rng.choice("abcdefghilmnorst,.") for _ in range(rng.randint(1, 9))) for _ in range(500)]
    for text, ids in zip(found, encode(model, found)):
        best = library.nbest_encode_as_ids(text, 8)
        score = lambda x: sum(model.score[i] if model.kinds[i] != sc.BYTE else 0.0 for i in x)
        assert ids == best[0] or score(ids) >= score(best[0]), text


def best_score(model, text: str) -> float:
    """Largest sum of scores over all ways to write the text, by plain dynamic programming."""
    pieces = {}
    for key, value in PIECES:
        pieces[key] = value
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 16), end):
            if (value := pieces.get(text[start:end])) is not None:
                best[end] = max(best[end], best[start] + value)
        if pieces.get(text[end - 1]) is None:
            best[end] = max(best[end], best[end - 1] + model.unknown_score)
    return best[-1]


with open(sc.MODEL, "rb") as _f:
    PIECES = [(p[1].decode(), p.get(2, 0.0)) for p in (dict(sc._fields(v)) for n, v in sc._fields(_f.read()) if n == 1) if p.get(3, 1) == sc.NORMAL]


def test_whole_texts_reach_the_best_score(model):
    names = [k for k, _ in PIECES]
    found = [t for t in texts(3, 20) if t and len(t) < 2000]
    for text, ids in zip(found, encode(model, found)):
        marked = "▁" + text.replace(" ", "▁")
        unknown = sum(1 for c in marked if c not in set(names))
        total = sum(model.score[i] for i in ids if model.kinds[i] == sc.NORMAL) + unknown * model.unknown_score
        assert total == pytest.approx(best_score(model, marked), rel=1e-12)


def test_trie_holds_exactly_its_keys():
    rng = random.Random(2)
    keys = sorted({bytes(rng.choices(range(256), k=rng.randint(1, 4))) for _ in range(3000)})
    trie = sc.DoubleArray(keys, list(range(len(keys))))

    def find(key):
        s = 0
        for c in key:
            t = int(trie.base[s]) + c
            if trie.check[t] != s:
                return -1
            s = t
        return int(trie.value[s])

    assert [find(k) for k in keys] == list(range(len(keys)))
    others = {bytes(rng.choices(range(256), k=rng.randint(1, 4))) for _ in range(3000)} - set(keys)
    assert all(find(k) == -1 for k in others)


def test_round_trips(model):
    found = [t or "" for t in texts(7)] + ["  a  b ", "\r\n\t", "<s></s><0x41>", "\x00", "x" * 5000, "é" * 700]
    ids, at = model.encode([t.encode() for t in found], {})
    assert model.decode(ids, at) == [t.encode() for t in found]


def test_full_cache_changes_nothing(model, monkeypatch):
    found = [t or "" for t in texts(7)]
    want = encode(model, found)
    monkeypatch.setattr(sc, "CACHE_BYTES", 4000)
    cache = {}
    got = [encode_one for t in found for encode_one in [model.encode([t.encode()], cache)[0].tolist()]]
    assert got == want


def test_long_segments_reach_the_best_score_in_windows(model, monkeypatch):
    """Cuts between characters and windows of any size lose nothing of the sum."""
    rng = random.Random(4)
    han = "".join(chr(rng.randint(0x4E00, 0x4EFF)) for _ in range(400))
    found = [han, "x" * 900, "ab" * 500, " " * 300, "é" * 333, "".join(rng.choice("theraionsd") for _ in range(1500)), "a" * 100 + han[:50] + "😀" * 40 + "the" * 90]
    names = {k for k, _ in PIECES}
    for window in (64, 200, 1 << 13):
        monkeypatch.setattr(sc, "WINDOW_BYTES", window)
        monkeypatch.setattr(sc, "CHUNK_BYTES", 3 * window)
        for text, ids in zip(found, encode(model, found)):
            marked = "▁" + text.replace(" ", "▁")
            unknown = sum(1 for c in marked if c not in names)
            total = sum(model.score[i] for i in ids if model.kinds[i] == sc.NORMAL) + unknown * model.unknown_score
            assert total == pytest.approx(best_score(model, marked), rel=1e-12)
            assert model.decode(np.array(ids, np.int32), np.array([0, len(ids)])) == [text.encode()]


@pytest.mark.parametrize("unit", ["語彙とは語の", "xyz", "ab "])
def test_memory_of_a_very_long_text_is_bounded(model, unit):
    text = (unit * (4 << 20))[: (4 << 20) // len(unit[0].encode())].encode()
    tracemalloc.start()
    ids, at = model.encode([text], {})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.decode(ids, at) == [text]
    assert peak < 30 * len(text)


def test_rows(spark):
    t = texts(2, 10) + ["has ▁ inside"]
    docs = spark.createDataFrame(rows(t), DOCS).withColumn("ids", sc.F.lit("clash"))
    out = sc.encode_texts(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "order", "block", "rest", "n_tokens", "ids", "round_trip"]
    for r in out.collect():
        assert r.text == t[r.doc_id] and r.n_tokens == len(r.ids) and r.round_trip == ("▁" not in (r.text or ""))
    back = {r.doc_id: r.text for r in sc.decode_ids(out).collect()}
    assert all(back[i] == (x or "").replace("▁", " ") for i, x in enumerate(t))
    assert sc.encode_texts(docs.where("false")).count() == 0
