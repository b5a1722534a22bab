"""store_level_360: one row per store location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pos360.operators.ranking import top1_per_key
from pos360.params import DEFAULT, RunParams
from pos360.plans.order_mart import _look_up, _spread, one_product, one_store
from pos360.session import write_and_read
from pos360.sources.fixtures import Tables

STORE_MART_COLUMNS = (
    "store_id", "seller_city", "seller_state", "region", "total_transactions", "total_quantity_sold",
    "total_sales", "average_discount", "total_profit", "distinct_customers_visited", "distinct_products_sold",
    "distinct_categories_sold", "highest_selling_product", "most_frequent_customer",
    "transactions_with_discount", "transactions_with_loss", "most_common_payment_type",
    "average_customer_satisfaction", "active_days", "max_transaction_date", "min_transaction_date",
)


def store_top_product(orders: DataFrame) -> DataFrame:
    """The product with the most quantity sold in each store."""
    per = orders.groupBy(F.col("delivered_store_id").alias("store_id"), "product_id").agg(
        F.sum("quantity").alias("total_quantity")
    )
    return top1_per_key(per, ["store_id"], [("total_quantity", False), ("product_id", True)])


def store_top_customer(orders: DataFrame) -> DataFrame:
    """The customer (raw id) with the most order lines in each store."""
    per = orders.groupBy(F.col("delivered_store_id").alias("store_id"), "customer_id").agg(
        F.count("order_id").alias("total_orders")
    )
    return top1_per_key(per, ["store_id"], [("total_orders", False), ("customer_id", True)])


def store_top_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """The most common payment type per store, counted over the inner
    join of lines and payments, i.e. per order (lines in the store) x
    (payments of the type); both factors are counted per order first."""
    per_order_lines = (
        orders.where(F.col("order_id").isNotNull())
        .groupBy("order_id", F.col("delivered_store_id").alias("store_id"))
        .agg(F.count(F.lit(1)).alias("__lines"))
    )
    per_order_pay = (
        payments.where(F.col("order_id").isNotNull())
        .repartition("order_id")
        .groupBy("order_id", "payment_type")
        .agg(F.count(F.lit(1)).alias("__pays"))
    )
    per = (
        per_order_lines.join(per_order_pay, "order_id")
        .groupBy("store_id", "payment_type")
        .agg(F.sum(F.col("__lines") * F.col("__pays")).alias("payment_count"))
    )
    return top1_per_key(per, ["store_id"], [("payment_count", False), ("payment_type", True)])


# A store's rows are dealt into so many parts by the value that is counted: a
# chain of few stores is then more than one task's work for each.
_PARTS = 16


def _first(*order: Column) -> Column:
    """Smallest of ordering columns as a struct: a pick that combines map-side."""
    return F.min(F.struct(*order))


def _side_by_side(frames: list[DataFrame]) -> DataFrame:
    """Store-grain frames joined on the store id, where NULL is a store of its own."""
    out = frames[0]
    for f in frames[1:]:
        other = f.withColumnRenamed("store_id", "__store")
        out = out.join(other, out["store_id"].eqNullSafe(other["__store"]), "left").drop("__store")
    return out


def _per_value(lines: DataFrame, value: str, *aggs: Column) -> DataFrame:
    """One row per store and value. All rows of a value of a store lie in one
    part of the store, so what is then counted, summed or picked by store
    combines to a row per part before it travels. (By (store, value) alone
    it would not where stores are many: each task has a few rows of each.)"""
    dealt = lines.withColumn("__part", F.pmod(F.hash(value), F.lit(_PARTS))).repartition("store_id", "__part")
    return dealt.groupBy("store_id", "__part", value).agg(F.count(F.lit(1)).alias("__rows"), *aggs)


def _payment_lists(payments: DataFrame) -> DataFrame:
    """One row per order: its payment types with the number of payments of each, as text."""
    per_type = (
        payments.where(F.col("order_id").isNotNull())
        .repartition("order_id")
        .groupBy("order_id", F.col("payment_type").alias("type"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_type.groupBy("order_id").agg(F.to_json(F.sort_array(F.collect_list(F.struct("type", "n")))).alias("__pays"))


def _review_sums(reviews: DataFrame) -> DataFrame:
    scored = reviews.where(F.col("score").isNotNull() & F.col("order_id").isNotNull())
    return scored.groupBy("order_id").agg(F.sum("score").alias("__score"), F.count("score").alias("__scores"))


def _with_copies(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """How many rows the catalogue has of each line's product, 1 where none: that many
    times the original's join repeats the line. Only ids that repeat are looked up."""
    repeated = repeated.select(F.col("product_id").alias("__repeated"), "__times")
    return lines.join(repeated, lines["product_id"] == repeated["__repeated"], "left").withColumn(
        "__copies", F.coalesce("__times", F.lit(1)).cast("int")).drop("__repeated", "__times")


# The columns that each aggregate of the mart gives.
_GOODS = {
    "total_transactions", "total_quantity_sold", "total_sales", "average_discount", "total_profit", "distinct_products_sold",
    "highest_selling_product", "transactions_with_discount", "transactions_with_loss", "average_customer_satisfaction",
    "max_transaction_date", "min_transaction_date",
}
_PEOPLE = {"distinct_customers_visited", "most_frequent_customer"}


def store_level_360(clean: Tables, params: RunParams = DEFAULT, columns: Sequence[str] = STORE_MART_COLUMNS) -> DataFrame:
    """Per store location, sums, distinct counts, mean review and the three top picks.

    ``columns`` names those wanted: only the aggregates that give them are
    planned (Catalyst can't drop a left join whose right side it doesn't know to
    be unique), and stores alone come from one distinct.

    The lines find their order's reviews and payment types where the cleaning
    left them. What the aggregates read of them is written once if several do.
    One aggregate by store and product gives the sums, dates, products, reviews and
    the top product; one each the customers, days, categories and payment types.
    Only pairs of store and product go to the catalogue. A product id that repeats
    multiplies its lines in the original: the sums count its copies. Locations
    are attached to the finished stores."""
    wanted = set(columns)
    if params.corrected:
        stores, products = one_store(clean.stores), one_product(clean.products)  # D13
    else:
        stores, products = clean.stores, clean.products.select("product_id", "category")
    day = F.to_date("bill_date_timestamp")
    lines = clean.orders.select(
        "order_id", F.col("delivered_store_id").alias("store_id"), "product_id", "customer_id", day.alias("__day"),
        "quantity", "total_amount", "discount", "mrp", "cost_per_unit", "profit")
    lines = lines.drop("mrp", "cost_per_unit") if params.corrected else lines.drop("profit")
    parts = [wanted & _GOODS, wanted & _PEOPLE, "active_days" in wanted, "distinct_categories_sold" in wanted, "most_common_payment_type" in wanted]
    goods, people, days, kinds, paid = parts
    mood = "average_customer_satisfaction" in wanted
    if mood or paid:
        lines = _spread(lines, ("order_id",))
        lines = _look_up(lines, _review_sums(clean.reviews), "order_id") if mood else lines
        lines = _look_up(lines, _payment_lists(clean.payments), "order_id") if paid else lines
        lines = lines.drop("__order_id")
    lines = lines.withColumn("__n", F.col("order_id").isNotNull().cast("int")).drop("order_id")
    several = sum(map(bool, parts)) > 1
    if goods and not params.corrected:
        repeated = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("__times")).where("__times > 1")
        # Written, it has a known size: where few ids repeat, the lines stay where they are.
        lines = _with_copies(lines, write_and_read(repeated, "repeated-products") if several else repeated)
    else:
        lines = lines.withColumn("__copies", F.lit(1))
    if several:
        lines = write_and_read(lines, "store-lines")
    profit = F.col("profit") if params.corrected else (F.col("mrp") - F.col("cost_per_unit")) * F.col("quantity")  # D11

    frames = []
    if goods:
        sold, copies = F.col("__sold"), F.col("__copies")
        of_copies = lambda c: F.coalesce(F.sum(F.when(c, copies)), F.lit(0))
        sums = {
            "total_transactions": F.sum(F.col("__n") * copies),
            "total_quantity_sold": F.sum(F.col("quantity") * copies),
            "total_sales": F.sum(F.col("total_amount") * copies),
            "__discount": F.sum(F.col("discount") * copies),
            "__discounts": of_copies(F.col("discount").isNotNull()),
            "total_profit": F.sum(F.col("__profit") * copies),
            "transactions_with_discount": of_copies(F.col("discount") > 0),
            "transactions_with_loss": of_copies(F.col("__profit") < 0),
        }
        if mood:
            sums |= {"__scored": F.sum(F.col("__score") * copies), "__weight": F.sum(F.col("__scores") * copies)}
        narrow = lines.select(
            "store_id", "product_id", "__day", "__n", "__copies", "quantity", "total_amount", "discount", profit.alias("__profit"),
            *(["__score", "__scores"] if mood else []))
        per_product = _per_value(
            narrow, "product_id", F.sum("quantity").alias("__sold"), F.max("__day").alias("__last"), F.min("__day").alias("__begin"),
            *[c.alias(name) for name, c in sums.items()])
        out = per_product.groupBy("store_id").agg(
            *[F.sum(name).alias(name) for name in sums],
            F.max("__last").alias("max_transaction_date"), F.min("__begin").alias("min_transaction_date"),
            F.count("product_id").alias("distinct_products_sold"),
            _first(sold.isNull(), -sold, F.col("product_id").alias("product_id")).alias("__product"),
        ).withColumns({
            "average_discount": F.try_divide(F.col("__discount").cast("double"), F.col("__discounts").cast("double")),
            "highest_selling_product": F.col("__product.product_id"),
        })
        if mood:
            out = out.withColumn("average_customer_satisfaction", F.round(F.try_divide("__scored", F.col("__weight").cast("double")), 9))
        frames.append(out.select("store_id", *[c for c in out.columns if c in wanted & _GOODS]))
    else:
        frames.append(lines.select("store_id").distinct())
    if people:
        per_customer = _per_value(lines.select("store_id", "customer_id", "__n"), "customer_id", F.sum("__n").alias("__n"))
        frames.append(
            per_customer.groupBy("store_id")
            .agg(F.count("customer_id").alias("distinct_customers_visited"),
                 _first(-F.col("__n"), F.col("customer_id").alias("customer_id")).alias("__customer"))
            .select("store_id", "distinct_customers_visited", F.col("__customer.customer_id").alias("most_frequent_customer")))
    if days:
        frames.append(_per_value(lines.select("store_id", "__day"), "__day").groupBy("store_id").agg(F.count("__day").alias("active_days")))
    if kinds:
        named = products.where(F.col("category").isNotNull())
        pairs = lines.select("store_id", "product_id").join(named, "product_id").select("store_id", "category")
        frames.append(_per_value(pairs, "category").groupBy("store_id").agg(F.count("category").alias("distinct_categories_sold")))
    if paid:
        # Counted over lines x payments of their order: stores have few different lists of payments, which are counted first.
        lists = lines.where(F.col("__pays").isNotNull()).groupBy("store_id", "__pays").agg(F.count(F.lit(1)).alias("__lines"))
        per_type = (
            lists.select("store_id", "__lines", F.explode(F.from_json("__pays", "array<struct<type:string,n:bigint>>")).alias("__of"))
            .groupBy("store_id", F.col("__of.type").alias("payment_type"))
            .agg(F.sum(F.col("__lines") * F.col("__of.n")).alias("payment_count"))
        )
        top = per_type.groupBy("store_id").agg(_first(-F.col("payment_count"), F.col("payment_type").alias("payment_type")).alias("__payment"))
        frames.append(top.select("store_id", F.col("__payment.payment_type").alias("most_common_payment_type")))
    out = _side_by_side(frames)
    # The original joins the payments' pick by an equal store id: a line without a store has none of the three picks.
    known = F.col("store_id").isNotNull()
    out = out.withColumns({
        c: F.when(known, F.col(c)) for c in ("highest_selling_product", "most_frequent_customer", "most_common_payment_type") if c in out.columns
    })
    return out.join(stores, "store_id", "left").select(*columns)
