"""Monthly trends, per-dimension breakdowns and rankings.

``om`` is the enriched order mart, ``cm`` the customer mart. Results are
sorted as the original reports sort them; sorting a grouped result is a
small range-partitioned sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pos360.functions.columns import month_abbr, month_long_label, month_short_label, ratio_pct
from pos360.operators.ranking import sort_columns
from pos360.params import DEFAULT, RunParams


def _sales(om: DataFrame, key: str, alias: str | None = None, profit: str | None = None) -> DataFrame:
    aggs = [F.sum("total_amount").alias("total_sales"), F.sum("quantity").alias("total_quantity")]
    if profit == "profit":
        aggs.append(F.sum("profit").alias("total_profit"))
    elif profit == "amount_minus_cost":
        aggs.append(F.sum(F.col("total_amount") - F.col("total_cost")).alias("total_profit"))
    out = om.groupBy(F.col(key).alias(alias or key)).agg(*aggs)
    return out.orderBy(F.col("total_sales").desc_nulls_last(), F.col(alias or key).asc_nulls_first())


def new_customers_by_month(cm: DataFrame) -> DataFrame:
    """Q22: customers by the month of their first purchase."""
    d = F.col("first_transaction_date")
    return (
        cm.where(d.isNotNull())
        .groupBy(month_long_label(d).alias("month"), F.year(d).alias("__y"), F.month(d).alias("__m"))
        .agg(F.count("custid").alias("new_customers"))
        .orderBy("__y", "__m")
        .select("month", "new_customers")
    )


def new_customer_revenue_by_month(om: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Q23: per month, revenue from customers whose first month it is.

    Reference (D09): the first month is min(year) with min(month) taken
    separately. Corrected: the month of the first order."""
    ts = F.col("order_date")
    monthly = om.where(F.col("custid").isNotNull()).groupBy(
        "custid", F.year(ts).alias("year"), F.month(ts).alias("month")
    ).agg(F.round(F.sum("total_amount"), 2).alias("revenue"), F.min(ts).alias("__first"))
    # A customer has one row per month here, so the window is bounded.
    own = Window.partitionBy("custid")
    if params.corrected:
        start = F.min("__first").over(own)
        first_year, first_month = F.year(start), F.month(start)
    else:
        first_year, first_month = F.min("year").over(own), F.min("month").over(own)
    is_new = (F.col("year") == F.col("first_year")) & (F.col("month") == F.col("first_month"))
    return (
        monthly.withColumns({"first_year": first_year, "first_month": first_month})
        .groupBy("year", "month")
        .agg(F.round(F.sum(F.when(is_new, F.col("revenue")).otherwise(0)), 2).alias("new_customer_revenue"))
        .orderBy("year", "month")
        .select(month_short_label(F.col("year"), F.col("month")).alias("year_month"), "new_customer_revenue")
    )


def category_month_trend(om: DataFrame) -> DataFrame:
    """Q24: sales, quantity and profit by year, month and category."""
    ts = F.col("order_date")
    return (
        om.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"), "product_category")
        .agg(
            F.sum("total_amount").alias("total_sales"),
            F.sum("quantity").alias("total_quantity"),
            F.sum(F.col("total_amount") - F.col("total_cost")).alias("total_profit"),
        )
        .withColumn("month_name", month_abbr(F.col("year"), F.col("month")))
        .orderBy(F.col("total_sales").desc_nulls_last(), "year", "month", F.col("product_category").asc_nulls_first())
        .select("year", "month", "month_name", "product_category", "total_sales", "total_quantity", "total_profit")
    )


def region_trend(om: DataFrame) -> DataFrame:
    """Q25: sales, quantity, profit and distinct orders by region."""
    return (
        om.groupBy("region")
        .agg(
            F.sum("total_amount").alias("total_sales"),
            F.sum("quantity").alias("total_quantity"),
            F.sum(F.col("total_amount") - F.col("total_cost")).alias("total_profit"),
            F.count_distinct("order_id").alias("total_orders"),
        )
        .orderBy(F.col("region").asc_nulls_first())
    )


#: Dimensions of ``sales_by_dimension``: those of Q25-Q28, Q30, Q32 and Q33.
DIMENSIONS = ("region", "store_id", "payment_type", "channel", "store_state", "gender")


def sales_by_dimension(om: DataFrame) -> DataFrame:
    """Q25-Q28, Q30, Q32, Q33 in one scan of the mart: per dimension and value,
    lines, sales, quantity, profit and margin (amount less cost).

    GROUPING SETS send each line once per dimension into a map-side aggregate;
    what is shuffled is one row per task, dimension and value. A NULL value of
    a dimension is told from one that is not grouped by ``grouping``."""
    name = F.coalesce(*[F.when(F.grouping(d) == 0, F.lit(d)) for d in DIMENSIONS])
    value = F.coalesce(*[F.when(F.grouping(d) == 0, F.col(d).cast("string")) for d in DIMENSIONS])
    return (
        om.select(*DIMENSIONS, "total_amount", "quantity", "profit", "total_cost")
        .groupingSets([[d] for d in DIMENSIONS], *DIMENSIONS)
        .agg(
            name.alias("dimension"), value.alias("value"), F.count(F.lit(1)).alias("transactions"),
            F.sum("total_amount").alias("total_sales"), F.sum("quantity").alias("total_quantity"),
            F.sum("profit").alias("total_profit"), F.sum(F.col("total_amount") - F.col("total_cost")).alias("total_margin"),
        )
        .select("dimension", "value", "transactions", "total_sales", "total_quantity", "total_profit", "total_margin")
        .orderBy("dimension", F.col("total_sales").desc_nulls_last(), F.col("value").asc_nulls_first())
    )


def store_trend(om: DataFrame) -> DataFrame:
    """Q26."""
    return _sales(om, "store_id")


def payment_trend(om: DataFrame) -> DataFrame:
    """Q27."""
    return _sales(om, "payment_type")


def channel_trend(om: DataFrame) -> DataFrame:
    """Q28."""
    return _sales(om, "channel", profit="profit")


def popular_category_by_store(om: DataFrame) -> DataFrame:
    """Q29: the best-selling category of every store; ties all kept (RANK)."""
    per = om.groupBy("store_id", "product_category").agg(
        F.sum("total_amount").alias("total_sales"), F.sum("quantity").alias("total_quantity")
    )
    w = Window.partitionBy("store_id").orderBy(F.col("total_sales").desc_nulls_last())
    return (
        per.withColumn("__rank", F.rank().over(w))
        .where(F.col("__rank") == 1)
        .drop("__rank")
        .orderBy(F.col("total_sales").desc_nulls_last(), F.col("store_id").asc_nulls_first(),
                 F.col("product_category").asc_nulls_first())
    )


def state_sales(om: DataFrame) -> DataFrame:
    """Q30: by ``store_state`` (the customer's state in reference mode, D04)."""
    return (
        om.groupBy(F.col("store_state").alias("state"))
        .agg(F.sum("total_amount").alias("total_sales"), F.sum("quantity").alias("total_quantity"),
             F.sum("profit").alias("profit"))
        .orderBy(F.col("total_sales").desc_nulls_last(), F.col("state").asc_nulls_first())
    )


def top10_expensive_products(om: DataFrame, params: RunParams = DEFAULT, k: int = 10) -> DataFrame:
    """Q31: the k (product, category) pairs with the highest unit cost (MRP
    in corrected mode, D20) and their share of all sales. The total is a
    scalar subquery (not a window over all groups, which would pull every
    group into one task)."""
    price = "mrp" if params.corrected else "cost_per_unit"
    per = om.groupBy("product_id", "product_category").agg(
        F.max(price).alias("max_price"), F.sum("total_amount").alias("total_sales")
    )
    # The grand total from the grouped rows (exact decimal sums): the
    # subquery shares the grouping's shuffle instead of re-reading the mart.
    total = per.agg(F.sum("total_sales")).scalar()
    order = sort_columns([("max_price", False), ("product_id", True), ("product_category", True)])
    return (
        per.orderBy(*order).limit(k)
        .withColumn("contribution_to_sales_percentage", ratio_pct(F.col("total_sales"), total))
        .orderBy(*order)
    )


def gender_sales(om: DataFrame) -> DataFrame:
    """Q32."""
    return _sales(om, "gender")


def payment_preferences(om: DataFrame) -> DataFrame:
    """Q33: lines and sales per payment type."""
    return (
        om.groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum("total_amount").alias("total_sales"))
        .orderBy(F.col("total_sales").desc_nulls_last(), F.col("payment_type").asc_nulls_first())
    )
