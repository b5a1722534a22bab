"""Registry of every query: key -> callable(spark, sf_dir) -> DataFrame.

A ``Workspace`` holds one run's tables: the raw inputs, the cleaning states
in script order (for the step-by-step audit/clean queries), the cleaned
tables and the three marts, all as lazy DataFrames. Registered queries
cast money (DECIMAL inside) to DOUBLE at the output edge.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pos360.functions.columns import money_to_double
from pos360.operators import quality as q
from pos360.params import DEFAULT, RunParams
from pos360.plans import analyses, kpi, rfm, trends
from pos360.plans.clean import clean_tables, mart_tables
from pos360.plans.customer_mart import customer_behaviour, customer_level_360, customer_payment_summary
from pos360.plans.order_mart import best_payment, order_level_360, order_level_enriched
from pos360.plans.store_mart import store_level_360, store_top_customer, store_top_payment, store_top_product
from pos360.session import join_in_place, write_and_read
from pos360.sources.fixtures import DATE_FORMATS, FIXTURE_PARAMS, Tables, fixture_tables, order_date_texts, order_value_texts
from pos360.sources.readers import audit_unparseable_dates, audit_unparseable_values


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, params: RunParams | None = None,
                 raw: Tables | None = None, marts: dict[str, DataFrame] | None = None,
                 write_clean_orders: bool = False):
        join_in_place(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        # The test tables come with dates of their own.
        self.params = params or (DEFAULT if sf_dir is None else FIXTURE_PARAMS)
        self._raw = raw
        self._marts = marts or {}
        # Reports are lazy plans, pruned to the columns they need, or read the
        # marts given here. Where a mart itself is the result, the cleaned
        # order lines are written once for its several reads.
        self.write_clean_orders = write_clean_orders

    @cached_property
    def raw(self) -> Tables:
        return self._raw if self._raw is not None else fixture_tables(self.spark, self.sf_dir)

    # Order-table states in script order (C03b -> C06 -> C09b -> C10b -> C11).
    @cached_property
    def orders_dropped(self) -> DataFrame:
        return q.clean_drop_year(self.raw.orders, self.params)

    @cached_property
    def orders_rounded(self) -> DataFrame:
        return q.clean_round_amounts(self.orders_dropped)

    @cached_property
    def orders_max_qty(self) -> DataFrame:
        return q.clean_keep_max_quantity(self.orders_rounded)

    @cached_property
    def orders_multi(self) -> DataFrame:
        return q.clean_multi_product_quantity(self.orders_max_qty, self.params)

    @cached_property
    def orders_total(self) -> DataFrame:
        return q.clean_recompute_total(self.orders_multi)

    @cached_property
    def payments_rounded(self) -> DataFrame:
        return q.clean_round_payments(self.raw.payments)

    @cached_property
    def clean(self) -> Tables:
        """Cleaned tables, lazy."""
        return clean_tables(self.raw, self.params)

    @cached_property
    def clean_written(self) -> Tables:
        """Cleaned tables as the marts read them, the order lines written once if wanted (see __init__)."""
        clean = mart_tables(self.raw, self.clean)
        if not self.write_clean_orders:
            return clean
        return replace(clean, orders=write_and_read(clean.orders, "clean-orders"))

    @cached_property
    def customer_mart(self) -> DataFrame:
        if "customer" in self._marts:
            return self._marts["customer"]
        return customer_level_360(self.clean_written, self.params)

    @cached_property
    def order_mart(self) -> DataFrame:
        if "order" in self._marts:
            return self._marts["order"]
        return order_level_enriched(self.clean_written, self.params)

    @cached_property
    def store_mart(self) -> DataFrame:
        if "store" in self._marts:
            return self._marts["store"]
        return store_level_360(self.clean_written, self.params)

    def stores_with(self, *columns: str) -> DataFrame:
        """The store mart's rows with these columns; only their aggregates are planned."""
        if "store" in self._marts:
            return self._marts["store"].select(*columns)
        return store_level_360(self.clean_written, self.params, columns)

    def lines_with(self, *columns: str) -> DataFrame:
        """The order mart's rows with these columns; only their look-ups are planned."""
        if "order" in self._marts:
            return self._marts["order"].select(*columns)
        return order_level_enriched(self.clean_written, self.params, columns)

    def customers_with(self, *columns: str) -> DataFrame:
        """The customer mart's rows with these columns; payments are read only for columns about them."""
        if "customer" in self._marts:
            return self._marts["customer"].select(*columns)
        return customer_level_360(self.clean_written, self.params, columns)

    @cached_property
    def segments(self) -> DataFrame:
        return rfm.rfm_segments(self.rfm_customers, self.params)

    @cached_property
    def rfm_customers(self) -> DataFrame:
        return self.customers_with("custid", "last_transaction_date", "frequency", "monetary")

    def building(self) -> "Workspace":
        """This workspace, with the cleaned lines written once: a mart as a
        result reads them several times."""
        return Workspace(self.spark, self.sf_dir, self.params, raw=self.raw, marts=self._marts, write_clean_orders=True)


Query = Callable[[Workspace], DataFrame]

_REGISTRY: dict[str, Query] = {
    # Each step on the table state the original applies it to.
    "audit_city_special_chars": lambda w: q.audit_city_special_chars(w.raw.customers),
    "clean_city_special_chars": lambda w: q.clean_city_special_chars(w.raw.customers),
    "audit_missing_category": lambda w: q.audit_missing_category(w.raw.products),
    "clean_missing_category": lambda w: q.clean_missing_category(w.raw.products),
    "audit_orders_in_year": lambda w: q.audit_orders_in_year(w.raw.orders, w.params),
    "clean_drop_year": lambda w: w.orders_dropped,
    "audit_unparseable_dates": lambda w: audit_unparseable_dates(
        order_date_texts(w.raw.orders), "bill_date_text", DATE_FORMATS),
    "audit_unparseable_values": lambda w: audit_unparseable_values(order_value_texts(w.raw.orders), "orders"),
    "audit_store_duplicates": lambda w: q.audit_store_duplicates(w.raw.stores),
    "clean_store_duplicates": lambda w: q.clean_store_duplicates(w.raw.stores),
    "audit_review_averages": lambda w: q.audit_review_averages(w.raw.reviews, w.raw.orders),
    "clean_reviews_one_per_order": lambda w: q.clean_reviews_one_per_order(w.raw.reviews, w.raw.orders),
    "clean_round_amounts": lambda w: w.orders_rounded,
    "clean_round_payments": lambda w: w.payments_rounded,
    "audit_payment_duplicates": lambda w: q.audit_payment_duplicates(w.payments_rounded),
    "clean_payment_duplicates": lambda w: q.clean_payment_duplicates(w.payments_rounded),
    "audit_amount_mismatch": lambda w: q.audit_amount_mismatch(
        w.orders_rounded, q.clean_payment_duplicates(w.payments_rounded), w.params),
    "audit_below_max_quantity": lambda w: q.audit_below_max_quantity(w.orders_rounded),
    "clean_keep_max_quantity": lambda w: w.orders_max_qty,
    "audit_multi_product_orders": lambda w: q.audit_multi_product_orders(w.orders_max_qty),
    "clean_multi_product_quantity": lambda w: w.orders_multi,
    "clean_recompute_total": lambda w: w.orders_total,
    "clean_cost_and_profit": lambda w: q.clean_cost_and_profit(w.orders_total),
    "clean_orders": lambda w: q.clean_orders(w.raw.orders, w.params),
    # T1-T3
    "customer_payment_summary": lambda w: customer_payment_summary(w.clean_written, w.params),
    "customer_behaviour": lambda w: customer_behaviour(w.clean_written, w.params),
    "customer_level_360": lambda w: w.customer_mart,
    "top1_payment_per_order": lambda w: best_payment(w.clean.payments),
    "order_level_360": lambda w: order_level_360(w.clean, w.params),
    "order_level_enriched": lambda w: w.order_mart,
    "store_top_product": lambda w: store_top_product(w.clean.orders),
    "store_top_customer": lambda w: store_top_customer(w.clean.orders),
    "store_top_payment": lambda w: store_top_payment(w.clean_written.orders, w.clean_written.payments),
    "store_level_360": lambda w: w.store_mart,
    # Q01-Q21
    "kpi_customers": lambda w: kpi.kpi_customers(w.customers_with("custid")),
    "kpi_orders": lambda w: kpi.kpi_orders(w.lines_with("order_id")),
    "kpi_total_discount": lambda w: kpi.kpi_total_discount(w.lines_with("discount")),
    "kpi_avg_discount_per_customer": lambda w: kpi.kpi_avg_discount_per_customer(w.customers_with("custid", "discount")),
    "kpi_avg_discount_per_order": lambda w: kpi.kpi_avg_discount_per_order(w.lines_with("discount"), w.params),
    "kpi_total_revenue": lambda w: kpi.kpi_total_revenue(w.lines_with("total_amount")),
    "kpi_total_profit": lambda w: kpi.kpi_total_profit(w.lines_with("profit")),
    "kpi_total_cost": lambda w: kpi.kpi_total_cost(w.lines_with("total_cost")),
    "kpi_total_quantity": lambda w: kpi.kpi_total_quantity(w.lines_with("quantity")),
    "kpi_products": lambda w: kpi.kpi_products(w.lines_with("product_id")),
    "kpi_categories": lambda w: kpi.kpi_categories(w.lines_with("product_category")),
    "kpi_stores": lambda w: kpi.kpi_stores(w.stores_with("store_id")),
    "kpi_locations": lambda w: kpi.kpi_locations(w.stores_with("seller_city", "seller_state")),
    "kpi_regions": lambda w: kpi.kpi_regions(w.stores_with("region")),
    "kpi_channels": lambda w: kpi.kpi_channels(w.clean.orders),
    "kpi_payment_methods": lambda w: kpi.kpi_payment_methods(w.lines_with("payment_type")),
    "kpi_profit_pct": lambda w: kpi.kpi_profit_pct(w.lines_with("profit", "total_cost")),
    "kpi_top_product": lambda w: kpi.kpi_top_product(w.lines_with("product_id")),
    "kpi_top_store": lambda w: kpi.kpi_top_store(w.stores_with("store_id", "total_profit")),
    "kpi_avg_satisfaction": lambda w: kpi.kpi_avg_satisfaction(w.lines_with("satisfaction_score"), w.params),
    "kpi_retention_rate": lambda w: kpi.kpi_retention_rate(w.customers_with("tenure")),
    "kpi_overview": lambda w: kpi.kpi_overview(w.lines_with(*kpi.OVERVIEW_COLUMNS), w.params),
    # Q22-Q33
    "new_customers_by_month": lambda w: trends.new_customers_by_month(w.customers_with("custid", "first_transaction_date")),
    "new_customer_revenue_by_month": lambda w: trends.new_customer_revenue_by_month(w.lines_with("custid", "order_date", "total_amount"), w.params),
    "category_month_trend": lambda w: trends.category_month_trend(w.lines_with("order_date", "product_category", "total_amount", "quantity", "total_cost")),
    "region_trend": lambda w: trends.region_trend(w.lines_with("region", "total_amount", "quantity", "total_cost", "order_id")),
    "sales_by_dimension": lambda w: trends.sales_by_dimension(w.lines_with(*trends.DIMENSIONS, "total_amount", "quantity", "profit", "total_cost")),
    "store_trend": lambda w: trends.store_trend(w.lines_with("store_id", "total_amount", "quantity")),
    "payment_trend": lambda w: trends.payment_trend(w.lines_with("payment_type", "total_amount", "quantity")),
    "channel_trend": lambda w: trends.channel_trend(w.lines_with("channel", "total_amount", "quantity", "profit")),
    "popular_category_by_store": lambda w: trends.popular_category_by_store(w.lines_with("store_id", "product_category", "total_amount", "quantity")),
    "state_sales": lambda w: trends.state_sales(w.lines_with("store_state", "total_amount", "quantity", "profit")),
    "top10_expensive_products": lambda w: trends.top10_expensive_products(w.lines_with("product_id", "product_category", "cost_per_unit", "total_amount"), w.params),
    "gender_sales": lambda w: trends.gender_sales(w.lines_with("gender", "total_amount", "quantity")),
    "payment_preferences": lambda w: trends.payment_preferences(w.lines_with("payment_type", "total_amount")),
    # F1-F4
    "rfm_recency": lambda w: rfm.rfm_recency(w.rfm_customers, w.params),
    "rfm_scores": lambda w: rfm.rfm_scores(w.rfm_customers, w.params),
    "rfm_segments": lambda w: w.segments,
    "rfm_segment_counts": lambda w: rfm.rfm_segment_counts(w.rfm_customers, w.params),
    # X1-X5
    "cohort_retention": lambda w: analyses.cohort_retention(w.lines_with("custid", "order_date")),
    "cross_sell_by_category": lambda w: analyses.cross_sell_by_category(w.lines_with("order_id", "product_category")),
    "cross_sell_pairs": lambda w: analyses.cross_sell_pairs(w.lines_with("order_id", "product_category"), w.clean.products),
    "seasonality_index": lambda w: analyses.seasonality_index(w.lines_with("order_date", "total_amount")),
    "satisfaction_by_dimension": lambda w: analyses.satisfaction_by_dimension(w.clean_written),
    "segment_performance": lambda w: analyses.segment_performance(w.lines_with("custid", "total_amount", "quantity", "profit"), w.segments),
}

# Corrected semantics for the queries whose results the
# decisions change on the test data: D04, D06, D08-D12, D20, D21.
CORRECTED_PARAMS = FIXTURE_PARAMS.with_(semantics="corrected")


def _corrected(w: Workspace) -> Workspace:
    return Workspace(w.spark, w.sf_dir, w.params.with_(semantics="corrected"), raw=w.raw, write_clean_orders=w.write_clean_orders)


_REGISTRY.update({
    "audit_amount_mismatch_corrected": lambda w: q.audit_amount_mismatch(
        w.orders_rounded, q.clean_payment_duplicates(w.payments_rounded), CORRECTED_PARAMS),
    "clean_orders_corrected": lambda w: q.clean_orders(w.raw.orders, CORRECTED_PARAMS),
    "customer_level_360_corrected": lambda w: _corrected(w).customer_mart,
    "order_level_enriched_corrected": lambda w: _corrected(w).order_mart,
    "store_level_360_corrected": lambda w: _corrected(w).store_mart,
    "rfm_segments_corrected": lambda w: _corrected(w).segments,
    "new_customer_revenue_by_month_corrected": lambda w: trends.new_customer_revenue_by_month(
        _corrected(w).lines_with("custid", "order_date", "total_amount"), CORRECTED_PARAMS),
    "top10_expensive_products_corrected": lambda w: trends.top10_expensive_products(
        _corrected(w).lines_with("product_id", "product_category", "mrp", "total_amount"), CORRECTED_PARAMS),
    "kpi_overview_corrected": lambda w: kpi.kpi_overview(_corrected(w).lines_with(*kpi.OVERVIEW_COLUMNS), CORRECTED_PARAMS),
})

KEYS = tuple(_REGISTRY)


def run(key: str, w: Workspace) -> DataFrame:
    """The registered query ``key`` on workspace ``w``, money as DOUBLE."""
    return money_to_double(_REGISTRY[key](w))


def query_callables(params: RunParams = FIXTURE_PARAMS) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def make(key: str):
        return lambda spark, sf_dir: run(key, Workspace(spark, sf_dir, params))

    return {k: make(k) for k in KEYS}
