"""order_level_360: one row per cleaned order line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pos360.functions.columns import numeric_id
from pos360.operators.ranking import top1_per_key
from pos360.params import DEFAULT, RunParams
from pos360.sources.fixtures import Tables

ORDER_MART_COLUMNS = (
    "order_id", "custid", "order_date", "product_id", "product_category", "quantity", "total_amount",
    "discount", "payment_type", "payment_amount", "satisfaction_score", "store_id", "store_city",
    "seller_state", "region",
)
ENRICHED_COLUMNS = ORDER_MART_COLUMNS + (
    "total_cost", "profit", "channel", "cost_per_unit", "mrp", "gender", "store_state",
)


def best_payment(payments: DataFrame) -> DataFrame:
    """The order's largest payment (ties by type)."""
    return top1_per_key(payments, ["order_id"], [("payment_value", False), ("payment_type", True)])


def best_review(reviews: DataFrame) -> DataFrame:
    """The order's highest score."""
    return top1_per_key(reviews.select("order_id", "score"), ["order_id"], [("score", False)])


def one_product(products: DataFrame) -> DataFrame:
    """One category per product id (the original takes any; here the first by name)."""
    return top1_per_key(products.select("product_id", "category"), ["product_id"], [("category", True)])


def one_store(stores: DataFrame) -> DataFrame:
    """One location per store id (first by city, state, region)."""
    return top1_per_key(
        stores, ["store_id"], [("seller_city", True), ("seller_state", True), ("region", True)]
    )


def _customer_attributes(customers: DataFrame) -> DataFrame:
    # The original fills Gender / Store_state with an UPDATE joined on the
    # customer id, which takes an arbitrary row when an id repeats; here the
    # smallest non-NULL value. Gender comes from the customer mart there,
    # whose Gender is this same customers' column for every mart id.
    return customers.groupBy("custid").agg(
        F.min("gender").alias("gender"), F.min("customer_state").alias("__customer_state")
    )


def _spread(lines: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Join keys ``__key`` as text. A NULL key finds nothing; it is replaced by
    a hash of its line, so that lines without one (all guests have no
    customer number) spread over all tasks instead of meeting in one. A key that
    is never NULL stays as it is, and with it the lines' partitioning by it."""
    own = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in lines.columns]).cast("string"))
    text = {k: F.col(k).cast("string") for k in keys}
    return lines.withColumns({f"__{k}": F.coalesce(c, own) if lines.schema[k].nullable else c for k, c in text.items()})


def _look_up(lines: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    d = dim.withColumn("__dim", F.col(key).cast("string")).drop(key)
    return lines.join(d, (lines[f"__{key}"] == d["__dim"]) & lines[key].isNotNull(), "left").drop("__dim")


# The columns of a cleaned line that a column of the mart is made of, where not itself.
_SOURCES = {
    "custid": ("customer_id",), "order_date": ("bill_date_timestamp",), "store_id": ("delivered_store_id",),
    "profit": ("total_amount", "total_cost"), "product_category": ("product_id",), "gender": ("customer_id",),
    "payment_type": ("order_id",), "payment_amount": ("order_id",), "satisfaction_score": ("order_id",),
    "store_city": ("delivered_store_id",), "seller_state": ("delivered_store_id",), "region": ("delivered_store_id",),
    "store_state": ("delivered_store_id", "customer_id"),
}


def _joined_lines(clean: Tables, params: RunParams, columns: Sequence[str]) -> DataFrame:
    """The lines with the wanted columns. A look-up that gives none of them is
    left out: every one adds at most one row to a line, so no line is lost or
    repeated. What the lines need not hold is dropped before a key's hash could
    read it. Look-ups by order come first, where the cleaning left the lines."""
    needed = {c for column in columns for c in _SOURCES.get(column, (column,))}
    lines = clean.orders.select(*[c for c in clean.orders.columns if c in needed])
    if "customer_id" in needed:
        lines = lines.withColumn("custid", numeric_id("customer_id")).drop("customer_id")
    wanted = set(columns)
    customers = wanted & ({"gender"} if params.corrected else {"gender", "store_state"})
    by_key = {
        "order_id": wanted & {"payment_type", "payment_amount", "satisfaction_score"},
        "custid": customers,
        "product_id": wanted & {"product_category"},
        "delivered_store_id": wanted & ({"store_city", "seller_state", "region"} | ({"store_state"} if params.corrected else set())),
    }
    lines = _spread(lines, tuple(k for k, given in by_key.items() if given))
    if wanted & {"payment_type", "payment_amount"}:
        lines = _look_up(lines, best_payment(clean.payments), "order_id")
    if "satisfaction_score" in wanted:
        lines = _look_up(lines, best_review(clean.reviews), "order_id")
    if customers:
        lines = _look_up(lines, _customer_attributes(clean.customers), "custid")
    if by_key["delivered_store_id"]:
        lines = _look_up(lines, one_store(clean.stores).withColumnRenamed("store_id", "delivered_store_id"), "delivered_store_id")
    # Products last: of all keys they leave the lines spread most evenly.
    if by_key["product_id"]:
        lines = _look_up(lines, one_product(clean.products), "product_id")
    cols = {c: F.col(c) for c in columns} | {
        "order_date": F.col("bill_date_timestamp"),
        "product_category": F.col("category"),
        "payment_amount": F.col("payment_value"),
        "satisfaction_score": F.col("score"),
        "store_id": F.col("delivered_store_id"),
        "store_city": F.col("seller_city"),
        # The line's own cost, channel, price (the original copies
        # them from an arbitrary line of the same order).
        "profit": F.col("total_amount") - F.col("total_cost"),
        "cost_per_unit": F.col("cost_per_unit").cast("decimal(18,2)"),
        # The original loads the *customer's* state here.
        "store_state": F.col("seller_state") if params.corrected else F.col("__customer_state"),
    }
    if not params.corrected:
        # The mart stores discount and score in INT columns (truncated).
        cols |= {"discount": F.col("discount").cast("int"), "satisfaction_score": F.col("score").cast("int")}
    return lines.select(*[cols[name].alias(name) for name in columns])


def order_level_360(clean: Tables, params: RunParams = DEFAULT) -> DataFrame:
    """Every line with its best payment, best review, product category
    and store location (money DECIMAL; cast at the output edge)."""
    return _joined_lines(clean, params, ORDER_MART_COLUMNS)


def order_level_enriched(clean: Tables, params: RunParams = DEFAULT, columns: Sequence[str] = ENRICHED_COLUMNS) -> DataFrame:
    """T2 + T2b: adds cost, profit, channel, unit cost and price, gender and
    store state, in the same single pass over the lines. ``columns`` names
    those wanted; only the look-ups that give them are planned."""
    return _joined_lines(clean, params, columns)
