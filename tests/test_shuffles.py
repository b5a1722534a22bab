"""Lines are shuffled no more often than their keys demand (broadcasts off, as with large tables)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from micro import micro_tables
from pos360.operators import quality as q
from pos360.plans.catalog import Workspace, run
from pos360.sources.fixtures import FIXTURE_PARAMS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _exchanges(df) -> list[str]:
    """What the plan shuffles by, one entry per exchange (reused ones apart)."""
    nodes = json.loads(df._jdf.queryExecution().executedPlan().toJSON())
    return [json.dumps(n["outputPartitioning"]) for n in nodes if n["class"].endswith("ShuffleExchangeExec")]


@pytest.mark.parametrize("key", ["clean_keep_max_quantity", "clean_multi_product_quantity", "clean_recompute_total",
                                 "clean_cost_and_profit", "clean_orders"])
def test_cleaning_adds_no_shuffle(spark, no_broadcast, key):
    """All exchanges are those of the views: lines by part, parts, lines by order and orders, for both scans."""
    assert len(_exchanges(run(key, Workspace(spark, SF_DIR)))) <= 8


def test_lines_without_an_order_still_spread(spark, no_broadcast):
    """A stored table may lack order ids; such lines do not meet in one task."""
    one = micro_tables(spark).orders.where("order_id is null").drop("line_no")
    lines = one.crossJoin(spark.range(8_000).select(F.col("id").cast("int").alias("line_no"))).select(*micro_tables(spark).orders.columns)
    sizes = [r["count"] for r in q.clean_orders(lines, FIXTURE_PARAMS).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8_000 and max(sizes) < 2 * min(sizes)


@pytest.fixture
def planned_as_is(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("key", ["clean_keep_max_quantity", "clean_orders", "clean_orders_corrected"])
def test_cleaning_of_broadcast_joins_shuffles_twice(spark, planned_as_is, key):
    """The view's joins are broadcasts here: lines go once, the statistics' lines once, both by order alone."""
    found = _exchanges(run(key, Workspace(spark, SF_DIR)))
    assert len(found) <= 2 and not any("customer_id" in e or "product_id" in e for e in found)


def _scans(df, *columns) -> int:
    """Scans of files that read all these columns."""
    nodes = json.loads(df._jdf.queryExecution().executedPlan().toJSON())
    outputs = [json.dumps(n["output"]) for n in nodes if n["class"].endswith("FileSourceScanExec")]
    return sum(all(f'"{c}"' in o for c in columns) for o in outputs)


@pytest.mark.parametrize("key", ["customer_behaviour", "kpi_retention_rate", "kpi_avg_discount_per_customer", "new_customers_by_month"])
def test_customers_need_one_pass_of_the_lines(spark, no_broadcast, key):
    """Sums and distinct counts come from the same lines, met by customer once."""
    df = run(key, Workspace(spark, SF_DIR))
    assert _scans(df, "l_suppkey") == 1
    assert sum("customer_id" in e and "order" not in e for e in _exchanges(df)) == 1


@pytest.mark.parametrize("key, lookups", [("top10_expensive_products", 1), ("top10_expensive_products_corrected", 1), ("popular_category_by_store", 1),
                                          ("kpi_overview", 3), ("kpi_overview_corrected", 3), ("seasonality_index", 0)])
def test_reports_look_up_what_they_read(spark, no_broadcast, key, lookups):
    """Other look-ups of the order mart are not planned (customers, stores, payments, reviews where not read)."""
    df = run(key, Workspace(spark, SF_DIR))
    assert _scans(df, "c_custkey") == _scans(df, "s_suppkey") == 0
    nodes = json.loads(df._jdf.queryExecution().executedPlan().toJSON())
    left = [n for n in nodes if n["class"].endswith("SortMergeJoinExec") and "LeftOuter" in json.dumps(n["joinType"])]
    # Two joins of the cleaning; top10 plans its grand total beside them.
    assert len(left) <= (2 + lookups) * (2 if "top10" in key else 1)


def test_customers_of_lines_without_an_order(spark, no_broadcast):
    """Lines without an order id (of a stored table) still find their customer's attributes."""
    from pos360.plans.clean import clean_tables
    from pos360.plans.order_mart import order_level_enriched

    clean = clean_tables(micro_tables(spark), FIXTURE_PARAMS)
    out = order_level_enriched(clean, FIXTURE_PARAMS)
    gender = {r["custid"]: r["g"] for r in clean.customers.groupBy("custid").agg(F.min("gender").alias("g")).collect()}
    rows = out.select("order_id", "custid", "gender").collect()
    assert len(rows) == clean.orders.count() and all(r["gender"] == gender.get(r["custid"]) for r in rows)
    assert any(r["order_id"] is None and r["custid"] is not None for r in rows)
