"""Operator 13 against brute force counts of all phrases."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from corpus import DOCS, rows, texts
from pos360.llm import collocations as co
from pos360.llm import textarrays as ta


def counts(docs):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i : i + k])] += 1
    return f, n


def answer_by_force(docs, least, top):
    f, n = counts(docs)
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, g), a in cand.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                if 100 * a >= 80 * f[lang, g[i : i + k]]:
                    covered.add((lang, g[i : i + k]))
    out = []
    for (lang, g), a in cand.items():
        if (lang, g) not in covered:
            score, k = min((2000000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g)))
            out.append((lang, -score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    ranked, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            ranked.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return ranked


def corpus(seed=8):
    rng = random.Random(seed)
    vocabulary = ["of", "the", "a", "Über", "語", "x" * 20, "naïve", "z#9", "on-line", "New", "York"]
    t = texts(seed, 40)
    for _ in range(200):
        t.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 25))) + rng.choice(["", ".", ", New York City of the "]))
    t += ["one two three four five six seven eight"] * 40 + ["five six seven\teight; nine  ten"] * 7 + ["hot pair " + "".join(rng.choice("abcdef") for _ in range(5)) for _ in range(150)]
    return rows(t)


def test_matches_brute_force(spark):
    data = corpus()
    docs = spark.createDataFrame(data, DOCS).repartition(4)
    for least, top in ((30, 2000), (3, 7), (1, 10**6)):
        got = [tuple(r) for r in co.collocations(docs, least, top).orderBy("lang", "rank").collect()]
        assert got == answer_by_force(data, least, top)


@pytest.mark.parametrize("hot", [False, True])
def test_spread_pairs_and_small_buckets_change_no_count(spark, monkeypatch, hot):
    data = corpus(9)
    docs = spark.createDataFrame(data, DOCS).repartition(3)
    monkeypatch.setattr(co, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(co, "GRAPH_BYTES", 3000)
    if hot:  # every pair is spread
        def every(texts, buckets, text_bytes):
            b = texts.toArrow().combine_chunks().to_batches()[0]
            _, lang, lang_hash = co._languages(b)
            return co.np.unique(co.Words(b["text"], lang, lang_hash).pair_hash())
        monkeypatch.setattr(co, "frequent_pairs", every)
    f, n = counts(data)
    phrases, total = co.phrase_counts(docs, 2)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()} == {k: v for k, v in f.items() if v >= 2}
    assert {r.lang: r.n for r in total.collect()} == {k: v for k, v in n.items() if v}


def test_frequent_pairs_are_found(spark):
    docs = co._texts(spark.createDataFrame(rows(["hot pair " + str(i) for i in range(500)]), DOCS).withColumn("lang", F.lit("en")))
    w = co.Words(pa.array(["hot pair x"]), co.np.zeros(1, int), ta.hash_spans(*[x for x in (co.np.frombuffer(b"en" + b"\0" * 8, co.np.uint8), co.np.array([0]), co.np.array([2]))]))
    assert w.pair_hash()[0] in co.frequent_pairs(docs, 8, 10_000)


def test_paths_are_compacted(spark):
    phrases, _ = co.phrase_counts(spark.createDataFrame(rows(["one two three four five six seven eight"] * 6 + ["x one two three four five y"] * 3, None), DOCS).withColumn("lang", F.lit("en")), 1)
    kept, inside = co.compact(phrases)
    assert {r.phrase for r in inside.collect()} == {"two three four", "four five six", "five six seven"}
    assert kept.count() == phrases.count() - 3
    assert {(r.phrase, r.words, r.f) for r in co.paths(phrases).collect()} == {
        ("x one two three", 4, 3), ("one two three four five", 5, 9), ("three four five six seven eight", 6, 6), ("three four five y", 4, 3)}


def test_two_contents_of_one_hash_stay_apart():
    buf, off = ta.column_bytes(pa.array(["ab cd ab cd ef"]))
    start, end, _ = ta.words(buf, off, ta.SPACE_SEPARATORS)
    assert ta.span_codes(buf, start, end, co.np.zeros(5, co.np.uint64)).tolist() == [0, 1, 0, 1, 2]


def test_edge_tables(spark):
    docs = spark.createDataFrame(rows([None, "", ". , ;", "one", "   "]), DOCS)
    assert co.collocations(docs).count() == 0 and co.collocations(docs.where(F.lit(False))).count() == 0
    clash = spark.createDataFrame(rows(["a b"] * 40), DOCS).withColumn("f", F.lit(1)).withColumn("phrase", F.lit("x")).withColumn("bucket", F.lit(2))
    assert {(r.lang, r.phrase, r.a) for r in co.collocations(clash, 13).collect()} == {("en", "a b", 14), ("de", "a b", 13), ("und", "a b", 13)}
