"""The cleaned input tables of one run."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pos360.operators import quality as q
from pos360.params import DEFAULT, RunParams
from pos360.sources.fixtures import Tables


def clean_tables(raw: Tables, params: RunParams = DEFAULT) -> Tables:
    """Apply every cleaning step. Reviews are averaged by order id without a
    look at the orders: a review of an unknown order can never match a cleaned
    order line (cleaned ids are a subset of the raw ones), so every mart gives
    the same rows as with the reviews of known orders."""
    return Tables(
        orders=q.clean_orders(raw.orders, params),
        customers=q.clean_city_special_chars(raw.customers),
        products=q.clean_missing_category(raw.products),
        stores=q.clean_store_duplicates(raw.stores),
        payments=q.clean_payment_duplicates(q.clean_round_payments(raw.payments)),
        reviews=q.average_reviews(raw.reviews),
    )


def payments_of_orders(raw: Tables) -> DataFrame:
    """The cleaned payments that have an order, partitioned by it: equal
    payments are of one order, so they meet there, and whoever counts or joins
    payments by order finds them in place. (By all columns, as for the whole
    table, they would be shuffled once for that and again by order.)"""
    known = q.clean_round_payments(raw.payments).where(F.col("order_id").isNotNull())
    return q.clean_payment_duplicates(known.repartition("order_id"))


def mart_tables(raw: Tables, clean: Tables) -> Tables:
    """The cleaned tables as the marts read them: a payment without an order joins nothing there."""
    return replace(clean, payments=payments_of_orders(raw))
