"""top1_per_key, dedupe_keep_one and the exact distributed NTILE."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pos360.operators import ranking
from pos360.operators.ranking import (
    dedupe_keep_one, exact_ntile, keys_at, ntile_by_cut_keys, ntile_of_position, sort_columns, top1_per_key)

def builtin_ntile(df, tiles, order, out_col):
    """Spark's own ntile over one window of all rows."""
    return df.withColumn(out_col, F.ntile(tiles).over(Window.orderBy(*sort_columns(order))))


SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("r", T.IntegerType()),
    T.StructField("m", T.DecimalType(18, 2)),
])


def _rows(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        r = rnd.choice([None, 1, 2, 2, 2, 3, 5, 8])  # heavy ties and NULLs
        m = None if rnd.random() < 0.1 else Decimal(rnd.choice([1, 5, 5, 5, 9])) / 4
        out.append((i, r, m))
    return out


ORDERS = [
    [("r", True), ("id", True)],
    [("r", False), ("id", True)],
    [("m", False), ("id", True), ("r", True)],
    [("m", True), ("r", False), ("id", True)],
]


@pytest.mark.parametrize("n", [0, 1, 3, 5, 13, 250])
@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("tiles", [1, 4, 7])
def test_exact_ntile_equals_builtin(spark, n, order, tiles):
    df = spark.createDataFrame(_rows(n, seed=n), SCHEMA)
    # Tiny ranges force many cut points.
    got = exact_ntile(df, tiles, order, "t", rows_per_range=7)
    want = builtin_ntile(df, tiles, order, "t")
    assert sorted(got.select("id", "t").collect()) == sorted(want.select("id", "t").collect())


@pytest.mark.parametrize("few", [2, 10_000])
@pytest.mark.parametrize("n, tiles", [(0, 4), (3, 4), (250, 7)])
def test_ntile_by_cut_keys_equals_builtin(spark, monkeypatch, n, tiles, few):
    monkeypatch.setattr(ranking, "SELECT_ROWS", few)  # few: every key is narrowed down to its last column
    df = spark.createDataFrame(_rows(n, seed=n), SCHEMA)
    orders = {f"t{i}": o for i, o in enumerate(ORDERS)}
    want = df
    for name, order in orders.items():
        want = builtin_ntile(want, tiles, order, name)
    got = ntile_by_cut_keys(df, tiles, orders)
    assert got.columns == want.columns and sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_cut_keys_narrow_over_rounds(spark, monkeypatch):
    """Far more rows than a window may have, two values that fill a third each, dates, extremes."""
    monkeypatch.setattr(ranking, "SELECT_ROWS", 50)
    df = spark.range(60_000).selectExpr(
        "id", "cast(case id % 3 when 0 then 7 when 1 then 9 else id * 7919 % 10007 end as int) AS v",
        "case when id % 11 > 0 then date_add(DATE'2020-01-01', cast(id * 31 % 977 as int)) end AS d", "cast(id * 7 % 60000 as decimal(38,2)) AS m")
    orders = {"a": [("v", True), ("id", False)], "b": [("d", False), ("id", True)], "c": [("m", False), ("id", True)], "e": [("d", True), ("v", False), ("id", True)]}
    want = df
    for name, order in orders.items():
        want = builtin_ntile(want, 4, order, name)
    got = ntile_by_cut_keys(df, 4, orders)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_keys_at_every_position(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SELECT_ROWS", 3)
    rows = [(a, b) for a in (1, 1, 2, 5, 5, 5) for b in (3, 4, -1)]
    df = spark.createDataFrame(rows, "a long, b long")
    assert keys_at(df, [(("a", "b"), p + 1) for p in range(len(rows))], len(rows)) == sorted(rows)


def test_text_keys_are_refused(spark):
    with pytest.raises(TypeError):
        ntile_by_cut_keys(spark.createDataFrame([("a",)], "s string"), 4, {"t": [("s", True)]})


def test_exact_ntile_one_hot_value_is_split(spark):
    # A third of the rows share one value: cut points on the whole key
    # (value + tie-break) still spread it over several buckets.
    rows = [(i, 1 if i % 3 == 0 else i, None) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    order = [("r", True), ("id", True)]
    got = exact_ntile(df, 4, order, "t", rows_per_range=100)
    want = builtin_ntile(df, 4, order, "t")
    assert sorted(got.select("id", "t").collect()) == sorted(want.select("id", "t").collect())


def test_ntile_sizes_differ_by_at_most_one(spark):
    df = spark.range(1, 1003).select(F.col("id"))
    for tiles in (4, 9):
        pos = df.withColumn("t", ntile_of_position(F.col("id"), 1002, tiles))
        sizes = [r["count"] for r in pos.groupBy("t").count().collect()]
        assert len(sizes) == tiles and max(sizes) - min(sizes) <= 1


def test_top1_per_key_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 5, "x"), ("a", 5, "b"), ("a", 1, "a"), ("b", None, "z"), ("b", 2, "y"), (None, 1, "q")],
        "k string, v int, t string",
    )
    got = top1_per_key(df, ["k"], [("v", False), ("t", True)]).collect()
    assert sorted((r.k or "", r.v, r.t) for r in got) == [("", 1, "q"), ("a", 5, "b"), ("b", 2, "y")]


def test_dedupe_keep_one(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 3)], "k string, v int")
    assert dedupe_keep_one(df, ["k", "v"]).count() == 3
    kept = dedupe_keep_one(df, ["k"]).collect()
    assert sorted((r.k or "", r.v) for r in kept) == [("", 3), ("a", 1)]


def test_exact_ntile_has_no_row_window(spark):
    df = spark.createDataFrame(_rows(50), SCHEMA)
    exact = exact_ntile(df, 4, ORDERS[0], "t", rows_per_range=7)
    plan = exact._jdf.queryExecution().executedPlan().toString()
    # Ranks come from range partitions written once; the only window is the
    # running sum over the per-range counts .
    assert "row_number" not in plan
    w = Window.orderBy("id")
    builtin_plan = df.withColumn("x", F.ntile(4).over(w))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in builtin_plan


def test_exact_ntile_many_ranges_large(spark):
    # 8,000 ranges over 200k rows, a third of them sharing one value.
    df = spark.range(0, 200_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 1000).alias("r"),
        (F.col("id") * 7919 % 1000).cast("decimal(18,2)").alias("m"),
    )
    order = [("r", True), ("m", False), ("id", True)]
    got = exact_ntile(df, 4, order, "t", rows_per_range=25)
    want = builtin_ntile(df, 4, order, "t")
    assert got.select("id", "t").exceptAll(want.select("id", "t")).count() == 0
    assert sorted(r["count"] for r in got.groupBy("t").count().collect()) == [50_000] * 4


@pytest.mark.parametrize("few", [20, 10_000])
def test_rfm_scores_equal_builtin(spark, monkeypatch, few):
    monkeypatch.setattr(ranking, "SELECT_ROWS", few)
    from pos360.plans import rfm
    from pos360.plans.catalog import Workspace

    w = Workspace(spark, "/root/testdata/sf0.001")
    want = rfm.rfm_base(w.customer_mart, w.params)
    for order, col in ((rfm.RECENCY_ORDER, "r"), (rfm.FREQUENCY_ORDER, "f"), (rfm.MONETARY_ORDER, "m")):
        want = builtin_ntile(want, 4, order, col)
    got = rfm.rfm_scores(w.customer_mart, w.params).select("custid", "recency_score", "frequency_score", "monetary_score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("custid", "r", "f", "m").collect()))


def test_rfm_keeps_customers_of_one_id_apart(spark):
    import datetime as dt

    from pos360.plans import rfm

    cm = spark.createDataFrame([(1, dt.date(2020, 1, d), d, float(d)) for d in (1, 2, 3, 4)],
                               "custid long, last_transaction_date date, frequency long, monetary double")
    got = rfm.rfm_scores(cm).orderBy("frequency").collect()
    assert [(r.recency_score, r.frequency_score, r.monetary_score) for r in got] == [(4, 4, 4), (3, 3, 3), (2, 2, 2), (1, 1, 1)]
