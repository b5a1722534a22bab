"""Analyses the README names without SQL behind them:
cohort retention, cross-selling, seasonality, satisfaction by dimension and
sales by RFM segment. All but X4 read the enriched order mart ``om``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pos360.functions.columns import float_avg, ratio_pct
from pos360.plans.order_mart import one_product
from pos360.sources.fixtures import Tables


def cohort_retention(om: DataFrame) -> DataFrame:
    """cohort = month of a customer's first order; for every later month
    offset, the customers of the cohort active then and their share (%) of the
    cohort. Distinct (customer, month) pairs are formed first, so the counts
    below are plain counts."""
    active = (
        om.where(F.col("custid").isNotNull() & F.col("order_date").isNotNull())
        .select("custid", F.trunc(F.to_date("order_date"), "month").alias("month"))
        .distinct()
    )
    # A customer has one row per month here, so the window is bounded.
    per = (
        active.withColumn("cohort_month", F.min("month").over(Window.partitionBy("custid")))
        .withColumn(
            "month_offset",
            (F.year("month") * 12 + F.month("month")) - (F.year("cohort_month") * 12 + F.month("cohort_month")),
        )
        .groupBy("cohort_month", "month_offset")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    size = F.max(F.when(F.col("month_offset") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort_month"))
    return (
        per.withColumn("retention_pct", ratio_pct(F.col("active_customers"), size))
        .orderBy("cohort_month", "month_offset")
    )


def cross_sell_by_category(om: DataFrame) -> DataFrame:
    """How often a category is bought together with other categories.

    Per category: orders containing it, how many of those also contain
    another category, that share (%), and the mean number of other
    categories in those orders. Built from distinct (order, category) rows
    and a per-order category count, so no pairs within an order are formed
    (a pair table grows with the square of the basket)."""
    oc = om.where(F.col("order_id").isNotNull()).select("order_id", "product_category").distinct()
    per_order = oc.groupBy("order_id").agg(F.count(F.lit(1)).alias("__n"))
    j = oc.join(per_order, "order_id")
    return (
        j.groupBy("product_category")
        .agg(
            F.count(F.lit(1)).alias("orders_with_category"),
            F.count_if(F.col("__n") > 1).alias("multi_category_orders"),
            F.sum(F.col("__n") - 1).alias("__others"),
        )
        .select(
            "product_category", "orders_with_category", "multi_category_orders",
            ratio_pct(F.col("multi_category_orders"), F.col("orders_with_category")).alias("cross_sell_pct"),
            F.try_divide(F.col("__others").cast("double"), F.col("orders_with_category").cast("double")).alias(
                "avg_other_categories"),
        )
        .orderBy(F.col("orders_with_category").desc(), F.col("product_category").asc_nulls_first())
    )


def basket_signatures(om: DataFrame, categories: DataFrame) -> DataFrame:
    """(signature, orders): how many orders have exactly the same categories.

    ``categories`` numbers the categories from 0 (``product_category``, ``__id``).
    An order's signature is a bitmap of them, as sorted (word, 64 bits) pairs:
    ``bit_or`` combines map-side, so a basket of any number of lines travels as
    one row per task and word. An order without a known category has an empty
    signature."""
    lines = om.where(F.col("order_id").isNotNull()).select("order_id", "product_category")
    bits = lines.join(categories, "product_category", "left").select(
        "order_id",
        F.expr("__id div 64").alias("__word"),
        F.expr("shiftleft(1L, cast(__id % 64 as int))").alias("__bit"),
    )
    words = bits.groupBy("order_id", "__word").agg(F.bit_or("__bit").alias("__bits"))
    present = F.when(F.col("__bits").isNotNull(), F.struct(F.col("__word").alias("word"), F.col("__bits").alias("bits")))
    per_order = words.groupBy("order_id").agg(F.sort_array(F.collect_list(present)).alias("signature"))
    return per_order.groupBy("signature").agg(F.count(F.lit(1)).alias("orders"))


def cross_sell_pairs(om: DataFrame, products: DataFrame) -> DataFrame:
    """For every two categories bought in one order, the orders with both,
    support (% of all orders), confidence in both directions (%) and lift.

    Pairs are expanded from distinct basket signatures, not from baskets: the
    output and each signature's share of it are bounded by the square of the
    number of categories, and no basket is capped. Every signature also holds
    the pseudo category -1, so that one aggregate gives the count of all orders
    (-1, -1), of those with a category (-1, a) and of those with both (a, b)."""
    # The catalogue's categories: a window over all of them is bounded.
    categories = products.where(F.col("category").isNotNull()).select(F.col("category").alias("product_category")).distinct().withColumn(
        "__id", (F.row_number().over(Window.partitionBy().orderBy("product_category")) - 1).cast("long"))
    bit = F.sequence(F.lit(0), F.lit(63))
    ids = F.flatten(F.transform("signature", lambda w: F.transform(
        F.filter(bit, lambda i: F.getbit(w["bits"], i) == 1), lambda i: w["word"] * 64 + i)))
    held = basket_signatures(om, categories).select("orders", F.concat(F.array(F.lit(-1).cast("long")), ids).alias("ids"))
    first = held.select("orders", "ids", F.explode("ids").alias("a"))
    both = first.select("orders", "a", F.explode(F.filter("ids", lambda x: x >= F.col("a"))).alias("b")).groupBy("a", "b").agg(F.sum("orders").alias("n"))
    single = both.where("a = -1").select(F.col("b").alias("id"), F.col("n").alias("orders"))
    named = single.join(categories, F.col("id") == F.col("__id")).select("id", "product_category", "orders")
    a = named.select(F.col("id").alias("a"), F.col("product_category").alias("category_a"), F.col("orders").alias("n_a"))
    b = named.select(F.col("id").alias("b"), F.col("product_category").alias("category_b"), F.col("orders").alias("n_b"))
    everything = single.where("id = -1").select(F.col("id").alias("__all"), F.col("orders").alias("n_all"))
    pairs = both.where("a >= 0 and a < b").join(a, "a").join(b, "b").withColumn("__all", F.least("a", F.lit(-1))).join(everything, "__all")
    real = lambda c: F.col(c).cast("double")
    return pairs.select(
        "category_a", "category_b", F.col("n").alias("orders_with_both"),
        ratio_pct(F.col("n"), F.col("n_all")).alias("support_pct"),
        ratio_pct(F.col("n"), F.col("n_a")).alias("confidence_a_to_b_pct"),
        ratio_pct(F.col("n"), F.col("n_b")).alias("confidence_b_to_a_pct"),
        (real("n") * real("n_all") / (real("n_a") * real("n_b"))).alias("lift"),
    ).orderBy(F.col("orders_with_both").desc(), "category_a", "category_b")


def seasonality_index(om: DataFrame) -> DataFrame:
    """For each month of the year, mean monthly sales over the years it
    occurs in, and its ratio to the mean over all (year, month) pairs."""
    ts = F.col("order_date")
    monthly = om.where(ts.isNotNull()).groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        F.sum("total_amount").alias("__sales")
    )
    per_month = monthly.groupBy("month").agg(F.sum("__sales").alias("__s"), F.count(F.lit(1)).alias("__y"))
    # At most 12 rows: a window over all of them is bounded.
    every = Window.partitionBy()
    return (
        per_month.select(
            "month",
            (F.col("__s").cast("double") / F.col("__y").cast("double")).alias("avg_sales"),
            (
                (F.col("__s").cast("double") / F.col("__y").cast("double"))
                / (F.sum("__s").over(every).cast("double") / F.sum("__y").over(every).cast("double"))
            ).alias("seasonality_index"),
        )
        .orderBy("month")
    )


def satisfaction_by_dimension(clean: Tables) -> DataFrame:
    """Mean order score per store, per category and per channel, of the
    averaged reviews as they are (the mart's column truncates them).

    One scan: each line is unpivoted into its three (dimension, value)
    pairs, reduced to distinct (dimension, value, order) rows, then joined
    with the scores and averaged."""
    lines = clean.orders.where(F.col("order_id").isNotNull()).select("order_id", "product_id", "delivered_store_id", "channel")
    pairs = lines.join(one_product(clean.products), "product_id", "left").select(
        "order_id",
        F.explode(F.array(
            F.struct(F.lit("store").alias("dimension"), F.col("delivered_store_id").cast("string").alias("value")),
            F.struct(F.lit("category").alias("dimension"), F.col("category").alias("value")),
            F.struct(F.lit("channel").alias("dimension"), F.col("channel").alias("value")),
        )).alias("d"),
    ).select("d.dimension", "d.value", "order_id").distinct()
    rated = pairs.join(clean.reviews.where(F.col("score").isNotNull()).select("order_id", "score"), "order_id")
    return (
        rated.groupBy("dimension", "value")
        .agg(float_avg("score").alias("avg_score"), F.count(F.lit(1)).alias("rated_orders"))
        .orderBy("dimension", F.col("value").asc_nulls_first())
    )


def segment_performance(om: DataFrame, segments: DataFrame) -> DataFrame:
    """Sales, quantity and profit per RFM segment. Lines are summed per
    customer first, so the join is at customer grain; a customer listed
    under several segments is counted in its first (by name)."""
    per_customer = om.where(F.col("custid").isNotNull()).groupBy("custid").agg(
        F.sum("total_amount").alias("total_sales"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("profit").alias("total_profit"),
    )
    seg = segments.groupBy("custid").agg(F.min("customer_segment").alias("customer_segment"))
    return (
        per_customer.join(seg, "custid")
        .groupBy("customer_segment")
        .agg(F.sum("total_sales").alias("total_sales"), F.sum("total_quantity").alias("total_quantity"),
             F.sum("total_profit").alias("total_profit"))
        .orderBy("customer_segment")
    )
