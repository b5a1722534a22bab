"""customer_level_360: one row per customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pos360.functions.columns import is_numeric_id, numeric_id
from pos360.operators.ranking import sort_columns, top1_per_key
from pos360.params import DEFAULT, RunParams
from pos360.sources.fixtures import Tables

# The payment types the mart pivots into columns.
PAYMENT_PIVOT = (
    ("Voucher", "transactions_paid_with_voucher"),
    ("Credit Card", "transactions_paid_with_credit_card"),
    ("Debit Card", "transactions_paid_with_debit_card"),
    ("UPI", "transactions_paid_with_upi"),
)

CUSTOMER_MART_COLUMNS = (
    "custid", "customer_city", "customer_state", "gender",
    "first_transaction_date", "last_transaction_date", "tenure", "inactive_days", "frequency",
    "monetary", "profit", "discount", "total_quantity",
    "distinct_items_purchased", "distinct_categories_purchased",
    "transactions_with_discount", "transactions_with_loss",
    "channels_used", "distinct_stores_purchased", "distinct_cities_purchased",
    "distinct_payment_types_used",
    *[name for _, name in PAYMENT_PIVOT],
    "preferred_payment_method",
)


def _customer_key(params: RunParams) -> str:
    # The original groups by the raw text id ('7' and '007' apart) and
    # joins by the numeric id; corrected mode groups by the numeric id.
    return "custid" if params.corrected else "customer_id"


def _numeric_lines(orders: DataFrame) -> DataFrame:
    return orders.where(is_numeric_id("customer_id")).withColumn("custid", numeric_id("customer_id"))


def _dims(clean: Tables, params: RunParams) -> tuple[DataFrame, DataFrame]:
    products = clean.products.select("product_id", "category")
    stores = clean.stores.select(F.col("store_id").alias("delivered_store_id"), "seller_city")
    if params.corrected:
        # One row per key so that a repeated id cannot multiply lines.
        products = top1_per_key(products, ["product_id"], [("category", True)])
        stores = top1_per_key(stores, ["delivered_store_id"], [("seller_city", True)])
    return products, stores


# What a row of ``_behaviour_by_order`` holds of its line.
_SUMS, _PRODUCT, _STORE = 0, 1, 2


def _amounts(params: RunParams) -> dict[str, Column]:
    """What is summed per customer."""
    if params.corrected:
        spent, gain = F.col("total_amount"), F.col("profit")  # D11
    else:
        spent, gain = F.col("cost_per_unit"), (F.col("mrp") - F.col("cost_per_unit")) * F.col("quantity")
    return {
        "monetary": spent,
        "profit": gain,
        "discount": F.col("discount"),
        "total_quantity": F.col("quantity").cast("bigint"),
        "transactions_with_discount": F.coalesce(F.col("discount") > 0, F.lit(False)).cast("bigint"),
        "transactions_with_loss": F.coalesce(F.col("mrp") < F.col("cost_per_unit"), F.lit(False)).cast("bigint"),
    }


def _value(kind: int, c: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), c.cast("string").alias("value"))


def _per_customer(rows: DataFrame, key: str, counted: Sequence[str]) -> DataFrame:
    """Rows that lie by customer, each with ``__of`` (kind 0: its sums and day,
    others: a value of a counted column), as one row per customer. ``count_distinct``
    would do the same, but Spark shuffles its copies of the rows, not the rows."""
    sums = {"first_transaction_date": F.min("__day"), "last_transaction_date": F.max("__day")}
    sums |= {name: F.sum(name) for name in rows.columns if name not in (key, "__day", "__of")}
    per_value = (
        rows.groupBy(key, F.col("__of.kind").alias("__kind"), F.col("__of.value").alias("__value"))
        .agg(*[c.alias(name) for name, c in sums.items()])
    )
    of_kind = lambda i: F.col("__kind") == i
    return per_value.groupBy(key).agg(
        *[F.max(F.when(of_kind(0), F.col(name))).alias(name) for name in sums],
        *[F.count_if(of_kind(i) & F.col("__value").isNotNull()).alias(name) for i, name in enumerate(counted, 1)],
    )


def _behaviour_by_line(lines: DataFrame, products: DataFrame, stores: DataFrame, key: str, amounts: dict[str, Column]) -> DataFrame:
    """Where an id may repeat in the catalogue (reference semantics): whole lines are
    joined with it, since the sums count every copy, and meet by customer once."""
    lines = lines.select(key, F.to_date("bill_date_timestamp").alias("__day"), "product_id", "delivered_store_id", "channel",
                         "quantity", "mrp", "cost_per_unit", "discount")
    lines = lines.join(products, "product_id", "left").join(stores, "delivered_store_id", "left")
    counted = {"frequency": "__day", "distinct_items_purchased": "product_id", "distinct_categories_purchased": "category",
               "channels_used": "channel", "distinct_stores_purchased": "delivered_store_id", "distinct_cities_purchased": "seller_city"}
    kinds = [_value(_SUMS, F.lit(None)), *[_value(i, F.col(c)) for i, c in enumerate(counted.values(), 1)]]
    rows = lines.repartition(key).select(key, "__day", *[c.alias(name) for name, c in amounts.items()], F.explode(F.array(*kinds)).alias("__of"))
    return _per_customer(rows, key, tuple(counted))


def _behaviour_by_order(lines: DataFrame, products: DataFrame, stores: DataFrame, key: str, amounts: dict[str, Column]) -> DataFrame:
    """Where every id of the catalogue is unique: amounts never travel to it. A
    line becomes three narrow rows, of its sums, its product and its store; the
    cleaning left the lines by order, so one row per order holds their sums. The
    rows meet the catalogue and then their customer, each once."""
    by_order = not lines.schema["order_id"].nullable
    lines = lines.select("order_id", key, F.to_date("bill_date_timestamp").alias("__day"), "channel", "product_id", "delivered_store_id",
                         *[c.alias(name) for name, c in amounts.items()])
    kinds = F.array(_value(_SUMS, F.lit(None)), _value(_PRODUCT, F.col("product_id")), _value(_STORE, F.col("delivered_store_id")))
    rows = lines.select("*", F.explode(kinds).alias("__of"))
    summed = F.col("__of.kind") == _SUMS
    rows = rows.where(summed | F.col("__of.value").isNotNull()).select(
        "order_id", key, F.col("__of.kind").alias("__kind"), F.col("__of.value").alias("__id"),
        *[F.when(summed, F.col(c)).alias(c) for c in ("__day", "channel", *amounts)])
    if by_order:
        rows = rows.groupBy("order_id", key, "__kind", "__id", "__day", "channel").agg(*[F.sum(c).alias(c) for c in amounts])
    # Rows of sums find nothing in the catalogue: their key, a hash, spreads
    # them. One struct holds what the other rows lack.
    own = F.hash("order_id", key, "__day").cast("string")
    rows = rows.select(key, "__kind", F.coalesce("__id", own).alias("__key"),
                       F.when(F.col("__kind") == _SUMS, F.struct("__day", "channel", *amounts)).alias("__sums"))
    named = products.select(F.lit(_PRODUCT).alias("__of"), F.col("product_id").alias("__name"), F.col("category").alias("__value")).unionByName(
        stores.select(F.lit(_STORE).alias("__of"), F.col("delivered_store_id").alias("__name"), F.col("seller_city").alias("__value")))
    rows = rows.join(named, (rows["__key"] == named["__name"]) & (rows["__kind"] == named["__of"]), "left")
    counted = {"frequency": (_SUMS, "__sums.__day"), "channels_used": (_SUMS, "__sums.channel"),
               "distinct_items_purchased": (_PRODUCT, "__key"), "distinct_categories_purchased": (_PRODUCT, "__value"),
               "distinct_stores_purchased": (_STORE, "__key"), "distinct_cities_purchased": (_STORE, "__value")}
    of = {kind: [_value(i, F.col(c)) for i, (k, c) in enumerate(counted.values(), 1) if k == kind] for kind in (_SUMS, _PRODUCT, _STORE)}
    of[_SUMS].append(_value(_SUMS, F.lit(None)))
    kind = F.col("__kind")
    values = F.when(kind == _SUMS, F.array(*of[_SUMS])).when(kind == _PRODUCT, F.array(*of[_PRODUCT])).otherwise(F.array(*of[_STORE]))
    rows = rows.select(key, "__kind", F.when(kind != _SUMS, F.col("__key")).alias("__key"), "__value", "__sums").repartition(key)
    return _per_customer(rows.select(key, "__sums.__day", *[f"__sums.{c}" for c in amounts], F.explode(values).alias("__of")), key, tuple(counted))


def customer_behaviour(clean: Tables, params: RunParams = DEFAULT) -> DataFrame:
    """Per customer, dates, tenure, sums and distinct counts of its lines.
    Rows meet by customer once; guests, who share no number, are not among them."""
    products, stores = _dims(clean, params)
    key = _customer_key(params)
    amounts = _amounts(params)
    lines = _numeric_lines(clean.orders)
    types = {name: lines.select(F.sum(c).alias("sum")).schema["sum"].dataType for name, c in amounts.items()}
    if params.corrected:
        # An id too long for BIGINT cannot be matched to a customer.
        out = _behaviour_by_order(lines.where(F.col("custid").isNotNull()), products, stores, key, amounts)
    else:
        out = _behaviour_by_line(lines, products, stores, key, amounts)
    out = out.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})
    if key == "customer_id":
        out = out.withColumn("custid", numeric_id("customer_id"))
    return out.withColumn("tenure", F.datediff("last_transaction_date", "first_transaction_date"))


def customer_payment_summary(clean: Tables, params: RunParams = DEFAULT) -> DataFrame:
    """Per customer and payment type, how often the type was used, and
    its rank (1 = most used; ties by type name).

    The original counts payment rows over an order-lines x payments join,
    i.e. per order (lines of the customer) x (payments of the type) (D12).
    Both factors are counted per order first, so the join is between two
    order-grain aggregates and never materialises the product."""
    key = _customer_key(params)
    lines = _numeric_lines(clean.orders)
    per_order_lines = lines.groupBy("order_id", key).agg(F.count(F.lit(1)).alias("__lines"))
    # By order alone: what is counted per type lies where the join needs it.
    # Payments that come partitioned so (``plans.clean``) stay where they are.
    paid = clean.payments.where(F.col("order_id").isNotNull()).repartition("order_id")
    per_order_pay = paid.groupBy("order_id", "payment_type").agg(F.count("payment_type").alias("__pays"))
    j = per_order_lines.join(per_order_pay, "order_id", "left")
    if params.corrected:
        # Orders paid with the type, counted once each.
        used = F.count_if(F.coalesce(F.col("__pays"), F.lit(0)) > 0)
    else:
        used = F.sum(F.col("__lines") * F.coalesce(F.col("__pays"), F.lit(0)))
    ps = j.groupBy(key, "payment_type").agg(used.cast("bigint").alias("payment_count"))
    w = Window.partitionBy(key).orderBy(*sort_columns([("payment_count", False), ("payment_type", True)]))
    ps = ps.withColumn("rn", F.row_number().over(w))
    if key == "customer_id":
        ps = ps.withColumn("custid", numeric_id("customer_id"))
    return ps.select("custid", "payment_type", "payment_count", "rn")


def _payment_columns(ps: DataFrame) -> DataFrame:
    aggs = [F.count_distinct("payment_type").alias("distinct_payment_types_used")]
    for type_name, col_name in PAYMENT_PIVOT:
        aggs.append(F.sum(F.when(F.col("payment_type") == type_name, F.col("payment_count")).otherwise(0)).alias(col_name))
    aggs.append(F.max(F.when(F.col("rn") == 1, F.col("payment_type"))).alias("preferred_payment_method"))
    return ps.groupBy("custid").agg(*aggs)


def customer_level_360(clean: Tables, params: RunParams = DEFAULT, columns: Sequence[str] = CUSTOMER_MART_COLUMNS) -> DataFrame:
    """Behaviour + customer attributes + payment pivot, one row per
    customer (money columns DECIMAL; cast at the output edge).

    Reference semantics: customer rows are not deduplicated, so the mart has
    one row per distinct (behaviour, city, state, gender) combination and the
    payment counts are multiplied by how many joined rows fell into it (what
    the original's join-then-GROUP-BY produces). That multiplicity is counted
    at customer grain and applied to per-customer payment totals, instead of
    joining payment rows into every duplicate. ``columns`` names those wanted:
    without one about payments these are not read."""
    cd = customer_behaviour(clean, params)
    customers = clean.customers.select("custid", "customer_city", "customer_state", "gender")
    cd_cols = [c for c in cd.columns if c not in ("customer_id", "custid")]
    if params.corrected:
        customers = top1_per_key(
            customers, ["custid"], [("customer_city", True), ("customer_state", True), ("gender", True)]
        )
        g = cd.join(customers, "custid", "left").withColumn("__mult", F.lit(1).cast("bigint"))
    else:
        g = (
            cd.drop("customer_id").join(customers, "custid", "left")
            .groupBy("custid", "customer_city", "customer_state", "gender", *cd_cols)
            .agg(F.count(F.lit(1)).alias("__mult"))
        )
    inactive = F.datediff(
        F.current_date() if params.inactive_as_of is None else F.lit(params.inactive_as_of), "last_transaction_date")
    if not set(columns) & {"distinct_payment_types_used", "preferred_payment_method", *(name for _, name in PAYMENT_PIVOT)}:
        return g.withColumn("inactive_days", inactive).select(*columns)
    out = g.join(_payment_columns(customer_payment_summary(clean, params)), "custid", "left")
    pay_sums = {
        name: (F.coalesce(F.col(name), F.lit(0)) * F.col("__mult")).cast("bigint") for _, name in PAYMENT_PIVOT
    }
    out = out.withColumns({
        **pay_sums,
        "distinct_payment_types_used": F.coalesce("distinct_payment_types_used", F.lit(0)).cast("bigint"),
        "inactive_days": inactive,
    })
    return out.select(*columns)
