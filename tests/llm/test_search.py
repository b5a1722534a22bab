"""Operator 12 against brute force over all documents."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import brute
from corpus import DOCS, PASSAGE, rows, texts
from pos360.llm import ranked_search as rs

ITEMS = "item_id long, text string, text2 string, items int"


def rank(docs, items, top):
    found = [(i, Counter(brute.ALNUM.findall(brute.lower(t or "")))) for i, t in docs]
    n_docs, total = sum(1 for _, c in found if c), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    queries: dict = {}
    for item, text in items:
        queries.setdefault(item, Counter()).update(brute.ALNUM.findall(brute.lower(text or "")))
    out = []
    for item, q in queries.items():
        scored = []
        for i, c in found:
            n = sum(c.values())
            m = 75 + 25 * n * n_docs // total if total else 0
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in q.items() if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def answer(docs, items, **options):
    return sorted((tuple(r) for r in rs.search(docs, items, **options).collect()), key=repr)


BENCH = [(1, PASSAGE, "", 0), (2, "the the quick a", "", 0), (2, "FOX, fox!", "", 0), (3, None, "", 0), (4, "", "", 0), (None, "word lazy dog", "", 0), (5, "no-such-word-anywhere qqq", "", 0), (6, "abc aß b 語 e ea " * 3, "", 0)]


def test_matches_brute_force(spark):
    t = texts(4, 80) + ["the quick brown fox"] * 30 + ["dog " * 500, "lazy", "The QUICK fox fox fox"]
    docs, items = spark.createDataFrame(rows(t), DOCS).repartition(5), spark.createDataFrame(BENCH, ITEMS)
    for top in (1, 3, 20):
        assert answer(docs, items, top=top) == rank(list(enumerate(t)), [b[:2] for b in BENCH], top)
    assert answer(docs, items, slice_bytes=60) == rank(list(enumerate(t)), [b[:2] for b in BENCH], 20)


def test_null_and_repeated_ids_and_empty_tables(spark):
    t = ["quick fox", "quick fox", "fox", "quick quick", None, "", "lazy dog"]
    ids = [7, None, 7, None, 7, 3, -1]
    docs, items = spark.createDataFrame(rows(t, ids), DOCS), spark.createDataFrame(BENCH, ITEMS)
    assert answer(docs, items) == rank(list(zip(ids, t)), [b[:2] for b in BENCH], 20)
    assert answer(docs.where(F.lit(False)), items) == answer(docs, items.where(F.lit(False))) == []
    assert answer(docs.where("text is null"), items) == []


def test_bounds_hold_and_documents_are_left_out(spark):
    """No score exceeds its bound; a document is never missed; most of the others are excluded."""
    t = [x for x in texts(6, 150) if x and brute.ALNUM.search(x)]
    q = rs.Queries([PASSAGE, "abc e ea b the fox"])
    docs = spark.createDataFrame(rows(t), DOCS).select("doc_id", F.col("text")).coalesce(1)
    q.weigh(*rs.corpus_counts(docs, q))
    index = rs.build_index(docs)
    got = {(r.item, r.doc_id): r.bound for r in rs.open_pairs(index, q, np.zeros(2, np.int64), np.full(2, rs._LAST)).collect()}
    exact = {(r.item, r.doc_id): r.score for r in rs.exact_scores(docs, spark.createDataFrame([(i, d, 0) for i in (0, 1) for d in range(len(t))], "item int, doc_id long, bound long"), q).collect()}
    assert set(exact) <= set(got) and all(got[k] >= s for k, s in exact.items())
    tight = sum(got[k] <= 1.2 * s for k, s in exact.items())
    assert tight > 0.8 * len(exact)


def test_terms_are_compared_byte_by_byte():
    q = rs.Queries(["alpha beta a-very-very-long-word" + "x" * 50])
    buf, start, end, h, _ = rs.terms(pa.array(["beta gamma alpha very word" + "x" * 50 + " word" + "x" * 49 + "y"]))
    place, term = q.find(buf, start, end, h)
    assert place.tolist() == [0, 2, 3, 4] and len(set(term.tolist())) == 4
    h[1] = q.hash[term[0]]  # another word of the same hash and length would not pass
    buf[start[1] : end[1]] = np.frombuffer(b"bexxa", np.uint8)
    assert rs.Queries.find(q, buf, start, end, h)[0].tolist() == [0, 2, 3, 4]
