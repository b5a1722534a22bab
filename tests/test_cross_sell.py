"""Category pairs by basket signatures against pairs formed basket by basket."""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import pytest

from pos360.plans.analyses import basket_signatures, cross_sell_pairs


def by_force(lines):
    baskets = defaultdict(set)
    for order, category in lines:
        if order is not None:
            baskets[order].add(category)
    one = Counter(c for b in baskets.values() for c in b if c is not None)
    two = Counter(p for b in baskets.values() for p in itertools.combinations(sorted(c for c in b if c is not None), 2))
    n = len(baskets)
    return {p: (k, 100.0 * k / n, 100.0 * k / one[p[0]], 100.0 * k / one[p[1]], k * n / (one[p[0]] * one[p[1]])) for p, k in two.items()}


def tables(spark, lines):
    om = spark.createDataFrame(lines, "order_id string, product_category string")
    products = spark.createDataFrame([(c,) for c in {c for _, c in lines}], "category string")
    return om, products


def check(spark, lines):
    got = {(r[0], r[1]): tuple(r[2:]) for r in cross_sell_pairs(*tables(spark, lines)).collect()}
    want = by_force(lines)
    assert got.keys() == want.keys()
    for p, v in want.items():
        assert got[p] == pytest.approx(v, rel=1e-12)


def test_pairs_match_pairs_of_baskets(spark):
    lines = [("o1", "a"), ("o1", "b"), ("o1", "b"), ("o2", "a"), ("o2", None), ("o3", None), (None, "a"), (None, "b"), ("o4", "c"), ("o4", "b"), ("o4", "a")]
    check(spark, lines)


def test_more_categories_than_bits_of_a_word(spark):
    lines = [(f"o{i % 40}", f"c{(i * 37) % 150:03d}") for i in range(900)] + [("all", f"c{c:03d}") for c in range(150)]
    check(spark, lines)


def test_a_huge_basket_is_one_signature(spark):
    """100,000 lines of one order become one row per category word, and no pair per line."""
    lines = [("huge", f"c{i % 3}") for i in range(100_000)] + [("small", "c0"), ("small", "c2")]
    om, products = tables(spark, lines)
    check(spark, lines)
    ids = products.orderBy("category").rdd.zipWithIndex().map(lambda x: (x[0][0], x[1])).toDF("product_category string, __id long")
    assert sorted((r.orders, [tuple(w) for w in r.signature]) for r in basket_signatures(om, ids).collect()) == [(1, [(0, 5)]), (1, [(0, 7)])]


def test_no_rows(spark):
    om, products = tables(spark, [("o", "a")])
    assert cross_sell_pairs(om, products).count() == 0
    assert cross_sell_pairs(om.where("false"), products.where("false")).count() == 0
