"""Operators 1 and 6 against brute force, on awkward texts and seeds."""

import pytest
from pyspark.sql import functions as F

import brute
from corpus import DOCS, rows, texts
from pos360.llm.substring_automaton import SuffixAutomaton, dedup_words
from pos360.llm.suffix_dedup import Levels, dedup_bytes

import numpy as np

BYTES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
WORDS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def frame(spark, found, ids=None):
    return spark.createDataFrame(rows(found, ids), DOCS)


def got(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("seed", [5, 6])
def test_bytes_match_brute_force(spark, seed):
    t = texts(seed)
    ids = [3 * i + 1 for i in range(len(t))]
    docs = frame(spark, t, ids).orderBy(F.rand(1))
    assert got(dedup_bytes(docs), BYTES) == sorted(brute.dedup_bytes(list(zip(ids, t))))


@pytest.mark.parametrize("seed", [5, 6])
def test_words_match_brute_force(spark, seed):
    t = texts(seed)
    docs = frame(spark, t).repartition(3)
    assert got(dedup_words(docs), WORDS) == sorted(brute.dedup_words(list(enumerate(t))))


@pytest.mark.parametrize("length", [10, 100, 300])
def test_other_lengths_in_bytes(spark, length):
    t = texts(5, 30)
    assert got(dedup_bytes(frame(spark, t), length), BYTES) == sorted(brute.dedup_bytes(list(enumerate(t)), length))


@pytest.mark.parametrize("window", [5, 80])
def test_other_lengths_in_words(spark, window):
    t = texts(5, 30)
    assert got(dedup_words(frame(spark, t), window), WORDS) == sorted(brute.dedup_words(list(enumerate(t)), window))


def test_lengths_that_do_not_fit(spark):
    for dedup, length in [(dedup_bytes, 7), (dedup_words, 0)]:
        with pytest.raises(ValueError, match="at least"):
            dedup(frame(spark, ["x"]), length)


def test_one_block_or_many_give_the_same(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    t = texts(9, 30)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = got(dedup_bytes(frame(spark, t)), BYTES), got(dedup_words(frame(spark, t)), WORDS)
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = got(dedup_bytes(frame(spark, t)), BYTES), got(dedup_words(frame(spark, t)), WORDS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert one == many


def test_repeated_and_null_ids(spark):
    long = "a long passage that is certainly more than fifty bytes long, and more than twenty words if one counts each of its many small words"
    docs = frame(spark, [long, long, long, "short", long], [None, None, 7, 7, 7])
    # A null id is smaller than 7; rows of one id do not count against each other.
    assert [(r.doc_id, r.n_removed) for r in dedup_bytes(docs).orderBy("doc_id", "n_bytes").collect()] == [(None, 0), (None, 0), (7, 0), (7, len(long)), (7, len(long))]
    words = len(long.split())
    assert [(r.doc_id, r.n_removed) for r in dedup_words(docs).orderBy("doc_id", "n_words").collect()] == [(None, 0), (None, 0), (7, 0), (7, words), (7, words)]


def test_hot_id_is_spread(spark):
    """One id on a third of the rows, one text on another third."""
    t = ["same words again and again in a row that is repeated so often that it must not end in a single task"] * 200 + texts(3, 20)
    ids = [5] * 100 + list(range(100, 100 + len(t) - 100))
    assert got(dedup_bytes(frame(spark, t, ids)), BYTES) == sorted(brute.dedup_bytes(list(zip(ids, t))))


def test_empty_table(spark):
    empty = frame(spark, ["x"]).where("false")
    assert dedup_bytes(empty).count() == 0 and dedup_words(empty).count() == 0


def test_rest_and_cut_characters(spark):
    shared = "é" * 30  # 60 bytes
    docs = frame(spark, ["a" + shared, "b" + shared + "语"])
    out = {r.doc_id: r for r in dedup_bytes(docs, keep_rest=True).collect()}
    assert out[1].kept_text == "b语" and out[1].rest.order == "o" and out[1].rest.block == 1


def test_levels_are_a_binary_counter():
    family = Levels()
    for i in range(11):
        family.add(np.array([b"%02d" % i, b"a"], "S50"), np.array([i, i]))
    assert [n for n, _, _ in family.levels] == [8, 2, 1]
    assert family.scan(np.array([b"07", b"a", b"zz"], "S50")).tolist() == [7, 0, np.iinfo(np.int64).max]


def test_automaton_gives_matching_statistics():
    a = SuffixAutomaton()
    added = ["abcabxabcd", "bxabd", "dddd"]
    for s in added:
        a.add(s)
    for query in ("abcabcabxabdd", "zzabdz", "ddddd"):
        want = [max(n for n in range(i + 1) if any(query[i - n : i] in s for s in added)) for i in range(1, len(query) + 1)]
        assert list(a.matching(query)) == want
