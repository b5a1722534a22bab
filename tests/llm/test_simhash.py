"""Operator 4 against brute force, with linked fingerprints made on purpose."""

import random

import numpy as np
import pytest

import brute
from corpus import DOCS, rows, texts
from pos360.llm import simhash


def test_fingerprints_and_groups(spark):
    t = texts(8)
    prints = [brute.fingerprint(x) for x in t]
    group = brute.groups(prints)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows(t), DOCS)).collect()}
    assert found == {i: (f"{p:016x}", g) for i, (p, g) in enumerate(zip(prints, group))}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_of_near_fingerprints(spark, seed):
    """Chains, stars and copies a few bits apart: the groups are those of all pairs."""
    rng = random.Random(seed)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            prints.append(base)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                base ^= 1 << b
    prints += [0, 1, 3, 7, (1 << 64) - 1, (1 << 63) | 1]
    want = brute.groups(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fingerprint long")
    assert {r.doc_id: r.component_id for r in simhash.groups(df).collect()} == dict(enumerate(want))


def test_long_lists_use_lookups():
    """A list beyond the pairwise size gives what pairs give."""
    rng = np.random.default_rng(3)
    base = np.uint64(0x1234567800000000)
    free = rng.choice(1 << 16, 900, replace=False).astype(np.uint64)
    prints = np.sort(base | ((free & np.uint64(0xFF)) << np.uint64(8)) | ((free >> np.uint64(8)) << np.uint64(24)))
    label = simhash.local_groups(prints, 2)
    assert label.tolist() == brute.groups([int(p) for p in prints])


def test_one_of_each(spark):
    same = "a b c d e f g h i j k l m n o p"
    t = [same, same.upper(), "", None, "other words entirely here now", same]
    ids = [4, 2, 9, None, 6, 2]
    kept = simhash.one_of_each(spark.createDataFrame(rows(t, ids), DOCS))
    assert sorted((r.doc_id, r.block) for r in kept.collect()) == [(2, 1), (6, 4), (9, 2)]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "order", "block", "rest"]


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame(rows([None, "", "x"], [None, 3, 4]), DOCS)
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect())[0] == (-1, "0" * 16, 3)
    assert simhash.near_duplicates(df.where("false")).count() == 0
