"""Operator 8 against brute force."""

from pyspark.sql import functions as F

import brute
from corpus import DOCS, PASSAGE, rows, texts
from pos360.llm import decontaminate

ITEMS = "item_id long, text string, text2 string"
BENCH = [(10, PASSAGE, "x"), (2, PASSAGE[4:90], "x"), (2, "Two words", "x"), (3, "", "x"), (4, None, "x"), (None, "wonder what", "x"), (7, "never, ever seen anywhere", "x"), (8, "语", "x")]


def answer(docs, benchmark, **options):
    out = decontaminate.contamination(docs, benchmark, **options)
    return sorted(
        (r[0], r[1], r[2], len(r[3]), brute.sha(",".join(r[3]).encode()), r[4])
        for r in out.select("doc_id", "#n_words", "#n_hit", "#items", "#contaminated").collect()
    )


def test_matches_brute_force(spark):
    t = texts(2) + ["A THE quick, brown fox jumps over the lazy dog while many other animals LOOK"]
    docs = spark.createDataFrame(rows(t), DOCS)
    bench = spark.createDataFrame(BENCH, ITEMS)
    want = sorted(brute.contamination(list(enumerate(t)), [b[:2] for b in BENCH]))
    assert answer(docs, bench) == want
    long = [b for b in BENCH if b[1] and len(b[1]) > 60]  # only full windows
    assert answer(docs, spark.createDataFrame(long, ITEMS)) == sorted(brute.contamination(list(enumerate(t)), [b[:2] for b in long]))


def test_slices_give_the_same(spark):
    t = texts(2, 20)
    docs, bench = spark.createDataFrame(rows(t), DOCS), spark.createDataFrame(BENCH, ITEMS)
    assert answer(docs, bench, slice_bytes=100) == answer(docs, bench)


def test_longest_match_and_place(spark):
    docs = spark.createDataFrame(rows(["so " + PASSAGE + " end"]), DOCS)
    r = decontaminate.contamination(docs, spark.createDataFrame(BENCH[:1], ITEMS)).head()
    assert [m.asDict() for m in r["#matches"]] == [{"item_id": "10", "item_start": 0, "doc_start": 1, "length": len(PASSAGE.split())}]


def test_removal_and_edge_tables(spark):
    docs, bench = spark.createDataFrame(rows([PASSAGE, "clean text", None], [1, 1, None]), DOCS), spark.createDataFrame(BENCH, ITEMS)
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.block for r in kept.collect()) == [1, 2]
    assert decontaminate.remove_contaminated(docs, bench.where("false")).count() == 3
    assert decontaminate.remove_contaminated(docs.where(F.lit(False)), bench).count() == 0
