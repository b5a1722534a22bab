"""Schema contracts of the six point-of-sale input tables.

The original tables carry no DDL; these types are inferred from how the
cleaning scripts use each column. Column names are snake_case; ``NAME_MAP``
maps the original spellings (mixed case, spaces) onto them once, in the reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("line_no", T.IntegerType()),
    T.StructField("channel", T.StringType()),
    T.StructField("delivered_store_id", T.StringType()),
    T.StructField("bill_date_timestamp", T.TimestampNTZType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("mrp", MONEY),
    T.StructField("cost_per_unit", MONEY),
    T.StructField("discount", MONEY),
    T.StructField("total_amount", MONEY),
])

CUSTOMERS = T.StructType([
    T.StructField("custid", T.LongType()),
    T.StructField("customer_city", T.StringType()),
    T.StructField("customer_state", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
])

STORES = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("seller_city", T.StringType()),
    T.StructField("seller_state", T.StringType()),
    T.StructField("region", T.StringType()),
])

PAYMENTS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("payment_value", MONEY),
])

REVIEWS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

SCHEMAS = {
    "orders": ORDERS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "stores": STORES,
    "payments": PAYMENTS,
    "reviews": REVIEWS,
}

# Original column spellings -> snake_case names.
NAME_MAP = {
    "Customer_id": "customer_id",
    "Channel": "channel",
    "Delivered_StoreID": "delivered_store_id",
    "Bill_date_timestamp": "bill_date_timestamp",
    "Quantity": "quantity",
    "MRP": "mrp",
    "Cost Per Unit": "cost_per_unit",
    "Discount": "discount",
    "Total Amount": "total_amount",
    "Custid": "custid",
    "Gender": "gender",
    "Category": "category",
    "StoreID": "store_id",
    "Region": "region",
    "Customer_Satisfaction_Score": "score",
}
