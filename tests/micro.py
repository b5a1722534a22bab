"""Hand-made micro tables for the edge cases the test data cannot reach
(FIXTURES.md §4): NULL keys and dates, '007' beside '7', duplicate
customers, a store id with two cities, repeated products, unpaid orders,
reviews of unknown orders, ties in every ranking."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import SparkSession

from pos360.sources.fixtures import Tables
from pos360.sources.schema import SCHEMAS


def ts(y, m, d):
    return dt.datetime(y, m, d, 10, 30)


# (order_id, customer_id, product_id, line_no, channel, store, date, qty, mrp, cost, discount, total)
ORDERS = [
    # customer '7': two orders; o1 has two products (quantity forced to 1)
    ("o1", "7", "p1", 1, "Online", "s1", ts(1999, 11, 5), 3, D("10.0040"), D("6.1234"), D("2.0000"), D("28.0040")),
    ("o1", "7", "p2", 2, "Online", "s1", ts(1999, 11, 5), 2, D("20.0000"), D("25.0000"), D("0.0000"), D("40.0000")),
    # repeated (customer, order, product) with a smaller quantity -> deleted
    ("o1", "7", "p1", 3, "Online", "s1", ts(1999, 11, 5), 1, D("10.0040"), D("6.1234"), D("0.0000"), D("10.0040")),
    ("o2", "7", "p3", 1, "Phone", "s2", ts(2000, 1, 9), 4, D("5.5550"), D("3.0000"), D("1.2500"), D("21.0000")),
    # the same customer spelled '007'
    ("o3", "007", "p1", 1, "Instore", "s3", ts(2000, 2, 1), 5, D("10.0040"), D("6.1234"), D("0.0000"), D("50.0200")),
    # guest (non-numeric id), an ISNUMERIC-only id and a NULL id
    ("o4", "GUEST-9", "p2", 1, "Online", "s1", ts(2000, 3, 3), 1, D("20.0000"), D("25.0000"), D("0.0000"), D("20.0000")),
    ("o5", "1e5", "p2", 1, "Online", "s1", ts(2000, 3, 4), 1, D("20.0000"), D("25.0000"), D("0.0000"), D("20.0000")),
    ("o6", None, "p4", 1, "Online", "s9", ts(2000, 3, 5), 2, D("7.0000"), D("5.0000"), D("0.5000"), D("13.5000")),
    # NULL date stays; a line of the dropped year goes
    ("o7", "8", "p4", 1, "Phone", "s2", None, 2, D("7.0000"), D("5.0000"), D("0.0000"), D("14.0000")),
    ("o8", "8", "p1", 1, "Phone", "s2", ts(2001, 5, 5), 1, D("10.0040"), D("6.1234"), D("0.0000"), D("10.0040")),
    # ties at the max quantity both stay; NULL product in a multi-product basket
    ("o9", "9", "p5", 1, "Instore", "s3", ts(1998, 12, 30), 2, D("3.3350"), D("1.0000"), D("0.0000"), D("6.6700")),
    ("o9", "9", "p5", 2, "Instore", "s3", ts(1998, 12, 30), 2, D("3.3350"), D("1.0000"), D("0.0000"), D("6.6700")),
    ("o9", "9", "p6", 3, "Instore", "s3", ts(1999, 1, 2), 3, D("4.0000"), D("2.0000"), D("0.2000"), D("11.8000")),
    ("o9", "9", None, 4, "Instore", "s3", ts(1999, 1, 2), 6, D("4.0000"), D("2.0000"), D("0.0000"), D("24.0000")),
    # NULL order id (never joins)
    (None, "9", "p6", 1, "Instore", "s3", ts(1999, 2, 2), 1, D("4.0000"), D("2.0000"), D("0.0000"), D("4.0000")),
    # customer 10 with an unpaid order
    ("o10", "10", "p3", 1, "Online", "s2", ts(1999, 6, 6), 2, D("5.5550"), D("3.0000"), D("0.0000"), D("11.1100")),
]

CUSTOMERS = [
    (7, "Pune@", "MH", "F"),
    (7, "Pune@", "MH", "F"),  # full duplicate: multiplies payment counts
    (8, "Delhi", "DL", "M"),
    (9, "Agra", "UP", None),
    (9, "Agra", "UP", "M"),  # same id, other gender -> two mart rows
    (10, "Goa@", "GA", "F"),
]

PRODUCTS = [
    ("p1", "Toys"),
    ("p1", "Games"),  # repeated product id
    ("p2", "#N/A"),
    ("p3", None),
    ("p4", "Food"),
    ("p5", "Food"),
    ("p6", "Toys"),
]

STORES = [
    ("s1", "Pune", "MH", "West"),
    ("s1", "Pune", "MH", "West"),  # full duplicate
    ("s2", "Delhi", "DL", "North"),
    ("s2", "Noida", "UP", "North"),  # one id, two cities
    ("s3", "Agra", "UP", None),
]

PAYMENTS = [
    ("o1", "UPI", D("30.0000")),
    ("o1", "Voucher", D("30.0000")),  # tie on value
    ("o1", "UPI", D("30.0000")),  # duplicate
    ("o2", "Credit Card", D("21.0049")),
    ("o3", "Debit Card", D("50.0200")),
    ("o4", "UPI", D("20.0000")),
    ("o6", None, D("13.5000")),
    ("o7", "Voucher", D("14.0000")),
    ("o9", "Voucher", D("40.0000")),
    ("o9", "Credit Card", D("9.1700")),
]

REVIEWS = [
    ("o1", 4.0),
    ("o1", 5.0),
    ("o2", 3.0),
    ("o3", 1.0),
    ("o3", 2.0),
    ("o3", 2.0),
    ("o9", 5.0),
    ("zz", 4.0),  # unknown order
    (None, 2.0),
]


def micro_tables(spark: SparkSession) -> Tables:
    rows = {"orders": ORDERS, "customers": CUSTOMERS, "products": PRODUCTS, "stores": STORES,
            "payments": PAYMENTS, "reviews": REVIEWS}
    return Tables(**{name: spark.createDataFrame(data, SCHEMAS[name]) for name, data in rows.items()})
