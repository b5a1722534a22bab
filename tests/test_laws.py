"""Properties: audit(clean(x)) is empty, totals are conserved across
breakdowns, results do not depend on the number of shuffle partitions,
filters reach the Parquet scan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from micro import micro_tables
from oracle_compare import digest
from pos360.operators import quality as q
from pos360.sources.fixtures import FIXTURE_PARAMS
from pos360.plans.catalog import Workspace, run

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def micro(spark):
    return micro_tables(spark)


@pytest.fixture(scope="module")
def fixture_ws(spark):
    return Workspace(spark, SF_DIR)


def test_audit_of_clean_is_empty(spark, micro, fixture_ws):
    for raw in (micro, fixture_ws.raw):
        assert q.audit_city_special_chars(q.clean_city_special_chars(raw.customers)).count() == 0
        assert q.audit_missing_category(q.clean_missing_category(raw.products)).count() == 0
        assert q.audit_orders_in_year(q.clean_drop_year(raw.orders)).first()[0] == 0
        assert q.audit_store_duplicates(q.clean_store_duplicates(raw.stores)).count() == 0
        pay = q.clean_round_payments(raw.payments)
        assert q.audit_payment_duplicates(q.clean_payment_duplicates(pay)).count() == 0
        assert q.audit_below_max_quantity(q.clean_keep_max_quantity(raw.orders)).count() == 0


def test_one_review_per_known_order(micro):
    cleaned = q.clean_reviews_one_per_order(micro.reviews, micro.orders)
    known = cleaned.join(micro.orders.select("order_id").distinct(), "order_id", "left_semi")
    assert known.groupBy("order_id").count().where("count > 1").count() == 0
    # Unknown and NULL-id reviews are untouched.
    assert cleaned.where(F.col("order_id").isNull() | (F.col("order_id") == "zz")).count() == 2


def test_null_keys_never_deleted_or_updated(micro):
    out = q.clean_orders(micro.orders, FIXTURE_PARAMS)
    assert out.where(F.col("order_id").isNull()).count() == 1
    # The NULL-product line of a multi-product basket is set to 1 (the
    # basket key is not NULL), the NULL-customer line keeps its quantity.
    assert out.where(F.col("product_id").isNull()).first().quantity == 1
    assert out.where(F.col("customer_id").isNull()).first().quantity == 2
    # NULL dates stay, the dropped year goes.
    assert out.where(F.col("bill_date_timestamp").isNull()).count() == 1
    assert out.where(F.year("bill_date_timestamp") == 2001).count() == 0


def test_sales_conserved_across_breakdowns(fixture_ws):
    total = run("kpi_total_revenue", fixture_ws).first()[0]
    for key in ("region_trend", "store_trend", "payment_trend", "channel_trend", "gender_sales", "state_sales"):
        s = run(key, fixture_ws).agg(F.sum("total_sales")).first()[0]
        assert s == pytest.approx(total, rel=1e-12), key
    cat = run("category_month_trend", fixture_ws).agg(F.sum("total_sales")).first()[0]
    assert cat == pytest.approx(total, rel=1e-12)


def test_mart_grains(fixture_ws):
    w = fixture_ws
    assert run("order_level_enriched", w).count() == w.clean.orders.count()
    numeric_ids = w.clean.orders.where(F.col("customer_id").rlike(r"^[+-]?[0-9]+$")).select("customer_id").distinct().count()
    assert run("customer_level_360", w).count() == numeric_ids
    seg = run("rfm_segment_counts", w).agg(F.sum("customer_count")).first()[0]
    assert seg == run("rfm_recency", w).count()


@pytest.mark.parametrize("key", ["customer_level_360", "store_level_360", "rfm_segments", "clean_orders",
                                 "popular_category_by_store"])
def test_partition_independence(spark, key):
    results = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 8, 200):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            df = run(key, Workspace(spark, SF_DIR))
            results.append(digest(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]


def test_drop_year_filter_reaches_scan(spark, micro, tmp_path):
    path = str(tmp_path / "orders")
    micro.orders.write.parquet(path)
    df = q.clean_drop_year(spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(bill_date_timestamp" in plan
    assert "GreaterThanOrEqual(bill_date_timestamp" in plan


def test_projection_is_pruned_at_scan(spark, tmp_path):
    # A KPI over the order mart reads only the columns it needs.
    w = Workspace(spark, SF_DIR)
    path = str(tmp_path / "om")
    run("order_level_enriched", w).write.parquet(path)
    from pos360.plans import kpi

    plan = kpi.kpi_total_revenue(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<total_amount:double>" in plan


def test_drop_year_independent_of_session_time_zone(spark, micro):
    old = spark.conf.get("spark.sql.session.timeZone")
    kept = []
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            kept.append(sorted((r.order_id or "", r.line_no) for r in q.clean_drop_year(micro.orders, FIXTURE_PARAMS).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert kept[0] == kept[1] == kept[2]
    assert ("o8", 1) not in kept[0]
