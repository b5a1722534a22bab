"""Data-quality operators: one ``audit_*`` (report) and one ``clean_*``
(transform) per check, SURVEY §2.1 C01-C12, plus the order-cleaning chain C00.

Every function is lazy and pure: an in-place ``UPDATE ... WHERE p`` becomes
``when(p, new).otherwise(old)``; a ``DELETE ... WHERE p`` becomes a filter
that keeps rows whose predicate is NULL (SQL deletes only where p is true).
Cleaners keep the input schema (C12 adds ``total_cost`` and ``profit``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pos360.functions.columns import MONEY, exact_avg, outside_year, year_range
from pos360.operators.ranking import dedupe_keep_one
from pos360.params import DEFAULT, RunParams

# Fixed values used by the original cleaning steps.
CITY_SPECIAL_CHARS = "@"
CITY_REPLACEMENT = " "
MISSING_CATEGORY_MARKER = "#N/A"
MISSING_CATEGORY_FILL = "Unknown"
ORDER_AMOUNT_COLUMNS = ("total_amount", "mrp", "cost_per_unit")
STORE_COLUMNS = ("store_id", "seller_city", "seller_state", "region")
PAYMENT_COLUMNS = ("order_id", "payment_type", "payment_value")
LINE_KEY = ("customer_id", "order_id", "product_id")
BASKET_KEY = ("customer_id", "order_id")
MISMATCH_TOLERANCE = 1


def _keep_unless(pred: Column) -> Column:
    """Row filter for ``DELETE WHERE pred``: NULL predicates keep the row."""
    return ~F.coalesce(pred, F.lit(False))


# C01 ----------------------------------------------------------------------

def audit_city_special_chars(customers: DataFrame, chars: str = CITY_SPECIAL_CHARS) -> DataFrame:
    pred = None
    for ch in chars:
        p = F.col("customer_city").contains(ch)
        pred = p if pred is None else pred | p
    return customers.where(pred).select("customer_city")


def clean_city_special_chars(
    customers: DataFrame, chars: str = CITY_SPECIAL_CHARS, replacement: str = CITY_REPLACEMENT
) -> DataFrame:
    city = F.col("customer_city")
    for ch in chars:
        city = F.replace(city, F.lit(ch), F.lit(replacement))
    return customers.withColumn("customer_city", city)


# C02 ----------------------------------------------------------------------

def audit_missing_category(products: DataFrame, marker: str = MISSING_CATEGORY_MARKER) -> DataFrame:
    return products.where(F.col("category") == marker).select("category")


def clean_missing_category(
    products: DataFrame, marker: str = MISSING_CATEGORY_MARKER, fill: str = MISSING_CATEGORY_FILL
) -> DataFrame:
    c = F.col("category")
    return products.withColumn("category", F.when(c == marker, F.lit(fill)).otherwise(c))


# C03 ----------------------------------------------------------------------

def audit_orders_in_year(orders: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Order lines billed in ``params.drop_year``; unparseable dates are not counted."""
    return orders.where(year_range(orders, "bill_date_timestamp", params.drop_year)).agg(
        F.count(F.lit(1)).alias("total_orders_in_year")
    )


def clean_drop_year(orders: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Delete lines billed in ``params.drop_year``; NULL or unparseable dates stay.
    Written as a half-open range so both bounds are pushed to the scan."""
    return orders.where(outside_year(orders, "bill_date_timestamp", params.drop_year))


# C04 ----------------------------------------------------------------------

def audit_store_duplicates(stores: DataFrame) -> DataFrame:
    return (
        stores.groupBy(*STORE_COLUMNS)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where(F.col("duplicate_count") > 1)
    )


def clean_store_duplicates(stores: DataFrame) -> DataFrame:
    return dedupe_keep_one(stores, STORE_COLUMNS)


# C05 ----------------------------------------------------------------------

def _order_ids(orders: DataFrame) -> DataFrame:
    # Distinct ids: the line-grained table is reduced map-side before the join.
    return orders.select("order_id").where(F.col("order_id").isNotNull()).distinct()


def audit_review_averages(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean score of every order that exists in ``orders``. Joining the
    line-grained table repeats each review equally often, which leaves the
    mean unchanged, so a semi-join gives the same rows (D05)."""
    return average_known_reviews(reviews, orders).withColumnRenamed("score", "avg_satisfaction_score")


def average_known_reviews(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """One averaged review row per order that exists in ``orders``."""
    return average_reviews(reviews.join(_order_ids(orders), "order_id", "left_semi"))


def average_reviews(reviews: DataFrame) -> DataFrame:
    """One averaged review row per order id, from an exact sum."""
    score = F.col("score").cast("decimal(18,6)")
    return reviews.groupBy("order_id").agg(exact_avg(score).alias("score"))


def clean_reviews_one_per_order(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """Reviews of known orders become one averaged row per order; reviews of
    unknown orders (and with a NULL id) stay as they are.

    Only this standalone result carries the untouched reviews: they can never
    join a cleaned order line (cleaned ids are a subset of the known ids), so
    the marts read plain averages by order id (see ``plans.clean``)."""
    untouched = reviews.join(_order_ids(orders), "order_id", "left_anti").select("order_id", "score")
    return average_known_reviews(reviews, orders).unionByName(untouched)


# C06 ----------------------------------------------------------------------

def _round_money(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 2).cast(df.schema[c].dataType) for c in cols})


def clean_round_amounts(orders: DataFrame) -> DataFrame:
    return _round_money(orders, ORDER_AMOUNT_COLUMNS)


def clean_round_payments(payments: DataFrame) -> DataFrame:
    return _round_money(payments, ["payment_value"])


# C07 ----------------------------------------------------------------------

def audit_payment_duplicates(payments: DataFrame) -> DataFrame:
    return (
        payments.groupBy(*PAYMENT_COLUMNS)
        .agg(F.count(F.lit(1)).alias("count_duplicates"))
        .where(F.col("count_duplicates") > 1)
    )


def clean_payment_duplicates(payments: DataFrame) -> DataFrame:
    return dedupe_keep_one(payments, PAYMENT_COLUMNS)


# C08 ----------------------------------------------------------------------

def audit_amount_mismatch(orders: DataFrame, payments: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Orders whose line totals and payments differ by more than 1.

    Reference: the outer join is filtered on the payment side, so unpaid
    orders drop out (D06). Corrected: an unpaid order counts as paid 0."""
    billed = orders.groupBy("order_id").agg(F.sum("total_amount").alias("orders_total_amount"))
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_total_amount"))
    j = billed.join(paid, "order_id", "left")
    if params.corrected:
        j = j.withColumn("payment_total_amount", F.coalesce("payment_total_amount", F.lit(0).cast(MONEY)))
    j = j.withColumn("mismatch_amount", F.col("orders_total_amount") - F.col("payment_total_amount"))
    return j.where(F.abs("mismatch_amount") > MISMATCH_TOLERANCE).select(
        "order_id", "orders_total_amount", "payment_total_amount", "mismatch_amount"
    )


# C09 / C10 ----------------------------------------------------------------
#
# The original finds group maxima / distinct-product counts with a grouped
# CTE joined back to the lines. Both are computed here as hash aggregates
# (map-side combine, so a hot order cannot overload one task) joined back on
# the group key. A line without customer or order joins nothing, as in the
# original, so it is neither deleted nor updated; where the order id may be
# NULL, such a line's join key is a hash of the line, which spreads these lines
# over all tasks. An id that is never NULL stays the key itself: lines that
# come partitioned by it are then grouped and joined where they are (see
# ``session.join_in_place``). The statistics are partitioned by the order alone
# however small the other tables of a view are (a broadcast join leaves its lines
# where the scan put them); the lines then follow with one shuffle for all joins.
# A window per group would need one task per group.

def _grouped_lines(orders: DataFrame) -> DataFrame:
    """The lines that have group statistics, partitioned by order. Lines
    already partitioned so stay where they are (Spark drops the shuffle)."""
    known = orders.where(_all_not_null(BASKET_KEY)).select(*LINE_KEY, "quantity")
    if orders.schema["order_id"].nullable:
        known = known.withColumn("order_id", F.coalesce("order_id", F.lit("")))
    return known.repartition("order_id")


def _max_quantities(orders: DataFrame) -> DataFrame:
    return _grouped_lines(orders).groupBy(*LINE_KEY).agg(F.max("quantity").alias("max_quantity"))



def _renamed_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in df.columns if c not in keys])


def _join_group_stats(lines: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    s = _renamed_keys(stats, keys).withColumn("__full", F.lit(True))
    full, order = _all_not_null(BASKET_KEY), F.col("order_id")
    if lines.schema["order_id"].nullable:
        order = F.coalesce(order, F.xxhash64(*[F.col(c) for c in lines.columns]).cast("string"))
    keyed = lines.withColumns({"__in": full, "__order": order})
    cond = (keyed["__order"] == s["__order_id"]) & (keyed["__in"] == s["__full"])
    for k in keys:
        if k == "customer_id":
            cond = cond & (keyed[k] == s[f"__{k}"])
        elif k != "order_id":
            cond = cond & keyed[k].eqNullSafe(s[f"__{k}"])
    return keyed.join(s, cond, "left").drop(*[f"__{k}" for k in keys], "__full", "__in", "__order")


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return cond


def _with_max_quantity(orders: DataFrame) -> DataFrame:
    return _join_group_stats(orders, _max_quantities(orders), LINE_KEY)


def _multi_product_stats(per_line: DataFrame) -> DataFrame:
    # ``per_line`` holds one row per distinct (customer, order, product), so
    # counting its non-NULL products per basket is an exact distinct count
    # done by two hash aggregates, each combined map-side.
    # ``max_quantity`` is read here too (the comparison holds for every
    # number): both uses of ``per_line`` then need the same columns, and the
    # second reuses the shuffle of the first.
    known = F.col("product_id").isNotNull() & (F.col("max_quantity").isNull() | (F.col("max_quantity") >= -(2**31)))
    return per_line.groupBy(*BASKET_KEY).agg((F.count_if(known) > 1).alias("__multi"))


def _with_multi_product(orders: DataFrame) -> DataFrame:
    return _join_group_stats(orders, _multi_product_stats(_max_quantities(orders)), BASKET_KEY)


def _below_max() -> Column:
    return _all_not_null(LINE_KEY) & (F.col("quantity") < F.col("max_quantity"))


def audit_below_max_quantity(orders: DataFrame) -> DataFrame:
    return _with_max_quantity(orders).where(_below_max()).select(*LINE_KEY, "quantity", "max_quantity")


def clean_keep_max_quantity(orders: DataFrame) -> DataFrame:
    return _with_max_quantity(orders).where(_keep_unless(_below_max())).select(*orders.columns)


def _multi_flag() -> Column:
    return _all_not_null(BASKET_KEY) & F.col("__multi")


def audit_multi_product_orders(orders: DataFrame) -> DataFrame:
    return _with_multi_product(orders).where(_multi_flag()).select(*LINE_KEY, "quantity")


def _set_quantity_one(df: DataFrame, flag: Column, params: RunParams) -> DataFrame:
    q = F.col("quantity")
    out = {"quantity": F.when(flag, F.lit(1)).otherwise(q)}
    if params.corrected:
        # Keep the discount per unit when the quantity is forced to 1.
        d = F.col("discount")
        scaled = F.try_divide(d, q).cast(df.schema["discount"].dataType)
        out["discount"] = F.when(flag & (q != 0), scaled).otherwise(d)
    return df.withColumns(out)


def clean_multi_product_quantity(orders: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    return _set_quantity_one(_with_multi_product(orders), _multi_flag(), params).select(*orders.columns)


# C11 / C12 ----------------------------------------------------------------

def _line_total() -> Column:
    return F.col("quantity") * F.col("mrp") - F.col("discount")


def clean_recompute_total(orders: DataFrame) -> DataFrame:
    t = F.col("total_amount")
    new = _line_total().cast(orders.schema["total_amount"].dataType)
    return orders.withColumn("total_amount", F.when(t != new, new).otherwise(t))


def clean_cost_and_profit(orders: DataFrame) -> DataFrame:
    cost = F.col("quantity") * F.col("cost_per_unit")
    return orders.withColumns({
        "total_cost": cost.cast(MONEY),
        "profit": F.round(F.col("total_amount") - cost, 2).cast(MONEY),
    })


# C00 ----------------------------------------------------------------------

def clean_orders(orders: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """The order-cleaning chain in script order: drop year -> round amounts ->
    keep max quantity -> quantity 1 on multi-product orders -> recompute
    total -> cost and profit (D07: the order matters).

    Deleting below-max lines never changes which products a (customer,
    order) holds, since each (customer, order, product) group keeps its
    max rows, so both group statistics come from one aggregation: the lines
    are scanned twice, once as lines and once for the statistics, whose
    shuffle serves both.
    """
    base = clean_round_amounts(clean_drop_year(orders, params))
    per_line = _max_quantities(base)
    stats = _join_group_stats(per_line, _multi_product_stats(per_line), BASKET_KEY)
    lines = _join_group_stats(base, stats, LINE_KEY)
    lines = lines.where(_keep_unless(_below_max()))
    lines = _set_quantity_one(lines, _multi_flag(), params).select(*orders.columns)
    return clean_cost_and_profit(clean_recompute_total(lines))
