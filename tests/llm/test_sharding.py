"""Operator 9: exact sizes, gapless slots, and the law of the shuffle."""

import math
import zlib
from collections import Counter

import numpy as np

from corpus import DOCS, rows, texts
from pos360.llm import sharding


def test_sizes_slots_and_digests(spark):
    t = texts(1) * 3
    out = sharding.shard_rows(spark.createDataFrame(rows(t), DOCS).repartition(5)).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(t)))
    for r in out:
        data = (t[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    per = Counter(r.shard for r in out)
    assert set(per) == set(range(16)) and max(per.values()) - min(per.values()) <= 1
    for s, n in per.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))


def test_fewer_rows_than_shards_equal_rows_and_no_rows(spark):
    docs = spark.createDataFrame(rows(["x"] * 5, [None, None, 1, 1, 1]), DOCS)
    out = sharding.shard_rows(docs).collect()
    assert len(out) == 5 and len({r.shard for r in out}) == 5 and all(r.slot == 0 for r in out)
    assert sharding.shard_rows(docs.where("false")).count() == 0


def test_matrix_sums():
    blocks = [7, 0, 65536, 3, 1000]
    m = np.array(sharding.communication_matrix(blocks, 16, 4))
    assert m.sum(axis=1).tolist() == blocks and np.ptp(m.sum(axis=0)) <= 1


def test_matrix_has_the_law_of_a_uniform_shuffle():
    """Rows of a block in a shard: mean and variance of the hypergeometric law."""
    blocks, shards, n = [40, 60], 4, 4000
    seen = np.array([sharding.communication_matrix(blocks, shards, s)[0][0] for s in range(n)])
    total, k, size = 100, 40, 25
    mean, var = size * k / total, size * k / total * (1 - k / total) * (total - size) / (total - 1)
    assert abs(seen.mean() - mean) < 4 * (var / n) ** 0.5 and abs(seen.var() / var - 1) < 0.1


def test_rows_are_spread_evenly(spark):
    """Neighbours of the input land in all shards alike (chi-squared with wide bounds)."""
    docs = spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text")
    out = sharding.shard_rows(docs).toPandas()
    first = out[out.doc_id < 5000].groupby("shard").size()
    expected = 5000 / 16
    assert ((first - expected) ** 2 / expected).sum() < 50
    assert abs(np.corrcoef(out.doc_id, out.slot)[0, 1]) < 0.05


def test_same_result_twice(spark):
    docs = spark.createDataFrame(rows(texts(1)), DOCS)
    one, two = (sorted((r.doc_id, r.shard, r.slot) for r in sharding.shard_rows(docs).collect()) for _ in range(2))
    assert one == two


def test_more_than_a_billion_rows():
    for blocks, shards in [([65_536, 300_000_000, 0, 400_000_000, 700_000_001, 1], 16), ([2**40, 65_536, 3], 3)]:
        m = np.array(sharding.communication_matrix(blocks, shards, 4))
        assert m.min() >= 0 and m.sum(axis=1).tolist() == blocks and np.ptp(m.sum(axis=0)) <= 1


def test_draws_have_the_hypergeometric_law():
    rng = np.random.default_rng(3)
    for good, bad, n in [(5, 7, 6), (3, 90, 40), (90, 3, 92)]:
        seen, draws = Counter(sharding.hypergeometric(good, bad, n, rng) for _ in range(5000)), 5000
        for x in range(n + 1):
            p = math.comb(good, x) * math.comb(bad, n - x) / math.comb(good + bad, n)
            assert abs(seen[x] - draws * p) <= 5 * (draws * p * (1 - p)) ** 0.5 + 1e-9
    good, bad, n, draws = 3 * 10**9, 10**9, 65_536, 1000
    seen = np.array([sharding.hypergeometric(good, bad, n, rng) for _ in range(draws)])
    assert abs(seen.mean() - n * 0.75) < 5 * (n * 0.1875 / draws) ** 0.5 and abs(seen.var() / (n * 0.1875) - 1) < 0.25
