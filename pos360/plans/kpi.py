"""Headline KPIs over the marts: one-row results.

``cm`` = customer mart, ``om`` = enriched order mart, ``sm`` = store mart,
``orders`` = cleaned order lines. Each KPI is one aggregate; ``kpi_overview``
computes every order-mart KPI in one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pos360.functions.columns import exact_avg, float_avg, int_avg, null_safe_concat, ratio_pct
from pos360.params import DEFAULT, RunParams


def _avg_int_or_exact(col: str, params: RunParams):
    # In the original these columns are INT, and AVG over INT is an
    # integer average.
    return exact_avg(col) if params.corrected else int_avg(col)


def kpi_customers(cm: DataFrame) -> DataFrame:
    return cm.agg(F.count_distinct("custid").alias("customers"))


def kpi_orders(om: DataFrame) -> DataFrame:
    return om.agg(F.count_distinct("order_id").alias("number_of_orders"))


def kpi_total_discount(om: DataFrame) -> DataFrame:
    return om.agg(F.sum("discount").alias("total_discount"))


def kpi_avg_discount_per_customer(cm: DataFrame) -> DataFrame:
    return cm.agg(exact_avg("discount").alias("avg_discount_per_customer"))


def kpi_avg_discount_per_order(om: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    return om.agg(_avg_int_or_exact("discount", params).alias("avg_discount_per_order"))


def kpi_total_revenue(om: DataFrame) -> DataFrame:
    return om.agg(F.sum("total_amount").alias("total_revenue"))


def kpi_total_profit(om: DataFrame) -> DataFrame:
    return om.agg(F.sum("profit").alias("total_profit"))


def kpi_total_cost(om: DataFrame) -> DataFrame:
    return om.agg(F.sum("total_cost").alias("total_cost"))


def kpi_total_quantity(om: DataFrame) -> DataFrame:
    return om.agg(F.sum("quantity").alias("total_quantity"))


def kpi_products(om: DataFrame) -> DataFrame:
    return om.agg(F.count_distinct("product_id").alias("total_products"))


def kpi_categories(om: DataFrame) -> DataFrame:
    return om.agg(F.count_distinct("product_category").alias("total_categories"))


def kpi_stores(sm: DataFrame) -> DataFrame:
    return sm.agg(F.count_distinct("store_id").alias("total_stores"))


def kpi_locations(sm: DataFrame) -> DataFrame:
    """Distinct 'city-state' texts; a NULL part counts as empty text."""
    return sm.agg(F.count_distinct(null_safe_concat("seller_city", F.lit("-"), "seller_state")).alias("total_locations"))


def kpi_regions(sm: DataFrame) -> DataFrame:
    return sm.agg(F.count_distinct("region").alias("total_regions"))


def kpi_channels(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count_distinct("channel").alias("total_channels"))


def kpi_payment_methods(om: DataFrame) -> DataFrame:
    return om.agg(F.count_distinct("payment_type").alias("total_payment_methods"))


def kpi_profit_pct(om: DataFrame) -> DataFrame:
    return om.agg(ratio_pct(F.sum("profit"), F.sum("total_cost")).alias("profit_percentage"))


def kpi_top_product(om: DataFrame) -> DataFrame:
    """Most frequent product (ties: smallest id). The limit is the report."""
    return (
        om.groupBy("product_id").agg(F.count("product_id").alias("frequency"))
        .orderBy(F.col("frequency").desc_nulls_last(), F.col("product_id").asc_nulls_first())
        .limit(1)
    )


def kpi_top_store(sm: DataFrame) -> DataFrame:
    """Most profitable store id, summed over its location rows (ties: smallest id)."""
    return (
        sm.groupBy("store_id").agg(F.sum("total_profit").alias("total_profit"))
        .orderBy(F.col("total_profit").desc_nulls_last(), F.col("store_id").asc_nulls_first())
        .limit(1)
    )


def kpi_avg_satisfaction(om: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    c = float_avg("satisfaction_score") if params.corrected else int_avg("satisfaction_score")
    return om.agg(c.alias("avg_customer_satisfaction"))


def kpi_retention_rate(cm: DataFrame) -> DataFrame:
    """Share (%) of customers whose tenure exceeds one day, in one pass."""
    return cm.agg(ratio_pct(F.count_if(F.col("tenure") > 1), F.count(F.lit(1))).alias("retention_rate"))


#: What ``kpi_overview`` reads of the mart.
OVERVIEW_COLUMNS = ("order_id", "product_id", "product_category", "payment_type", "satisfaction_score", "discount",
                    "total_amount", "profit", "total_cost", "quantity")


def kpi_overview(om: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Every order-mart KPI (Q02, Q03, Q05-Q11, Q16, Q17, Q20) in one scan."""
    sat = float_avg("satisfaction_score") if params.corrected else int_avg("satisfaction_score")
    return om.agg(
        F.count_distinct("order_id").alias("number_of_orders"),
        F.sum("discount").alias("total_discount"),
        _avg_int_or_exact("discount", params).alias("avg_discount_per_order"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("profit").alias("total_profit"),
        F.sum("total_cost").alias("total_cost"),
        F.sum("quantity").alias("total_quantity"),
        F.count_distinct("product_id").alias("total_products"),
        F.count_distinct("product_category").alias("total_categories"),
        F.count_distinct("payment_type").alias("total_payment_methods"),
        ratio_pct(F.sum("profit"), F.sum("total_cost")).alias("profit_percentage"),
        sat.alias("avg_customer_satisfaction"),
    )
