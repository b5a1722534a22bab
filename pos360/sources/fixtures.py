"""Point-of-sale views derived from the TPC-H-like test tables.

The test data holds no payments, reviews or product categories as such; the
views below derive them deterministically from ``lineitem orders part
customer supplier nation region`` (FIXTURES.md §2 defines them as SQL; the
same text is the DuckDB oracle's prefix in ``pos360.oracle``). Each view
only shapes rows into the input schema; no cleaning or mart logic happens
here.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pos360.params import RunParams


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Expressions of the fixture views (FIXTURES.md §2).
_PRICE2 = "CAST(p_retailprice AS DECIMAL(18,2))"
_QTY = "CAST(l_quantity AS INT)"
_DISC = "CAST(l_discount AS DECIMAL(4,2))"
_PAYMENT_TYPE = (
    "CASE __flags WHEN 'AF' THEN 'Credit Card' WHEN 'NF' THEN 'Credit Card' "
    "WHEN 'AO' THEN 'Voucher' WHEN 'RF' THEN 'Debit Card' ELSE 'UPI' END"
)


#: Spellings of the text dates besides the default one.
DATE_FORMATS = ("dd/MM/yyyy HH:mm",)
_DATE_TEXT = (
    "CASE WHEN line_no = 5 THEN concat('31/02/', date_format(bill_date_timestamp, 'yyyy HH:mm')) WHEN line_no = 6 THEN '' "
    "WHEN line_no % 2 = 0 THEN date_format(bill_date_timestamp, 'dd/MM/yyyy HH:mm') "
    "ELSE date_format(bill_date_timestamp, 'yyyy-MM-dd HH:mm:ss') END"
)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The narrow lines meet their parts first. The last join is on the text
    # ``order_id`` itself (as one-to-one as the number), so its rows leave it
    # partitioned by the column that the cleaning groups by; a line without an
    # order joins nothing, so the id is never NULL. What travels is cast before:
    # whole numbers and short decimals compress, doubles do not.
    li = _read(spark, sf_dir, "lineitem").where("l_orderkey IS NOT NULL").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", f"{_QTY} AS __qty", f"{_DISC} AS __disc",
        "coalesce(l_returnflag = 'R', false) AS __returned")
    o = _read(spark, sf_dir, "orders").where("o_orderkey IS NOT NULL").selectExpr(
        "CAST(o_orderkey AS STRING) AS __order", "o_custkey", "o_orderdate",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Online' WHEN '2-HIGH' THEN 'Phone' ELSE 'Instore' END AS channel")
    p = _read(spark, sf_dir, "part").selectExpr("p_partkey", f"{_PRICE2} AS __price")
    j = li.join(p, li.l_partkey == p.p_partkey).selectExpr("coalesce(CAST(l_orderkey AS STRING), '') AS order_id", "*")
    j = j.join(o, F.col("order_id") == F.col("__order"))
    return j.selectExpr(
        "order_id",
        "CASE WHEN o_custkey % 97 = 0 THEN concat('GUEST-', CAST(o_custkey AS STRING)) "
        "ELSE CAST(o_custkey AS STRING) END AS customer_id",
        "CAST(l_partkey AS STRING) AS product_id",
        "l_linenumber AS line_no",
        "channel",
        "CAST(l_suppkey AS STRING) AS delivered_store_id",
        "o_orderdate AS bill_date_timestamp",
        "__qty AS quantity",
        "CAST(__price + 0.0040 AS DECIMAL(18,4)) AS mrp",
        "CAST(__price * CASE WHEN __returned THEN 1.10 ELSE 0.75 END AS DECIMAL(18,4)) AS cost_per_unit",
        "CAST(__qty * __price * __disc AS DECIMAL(18,4)) AS discount",
        "CAST(__qty * __price * (1 - __disc) + CASE WHEN l_linenumber = 1 THEN 7.0040 ELSE 0.0000 END "
        "AS DECIMAL(18,4)) AS total_amount",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .where(F.col("c_custkey") % 50 != 7)
        .selectExpr(
            "c_custkey AS custid",
            "CASE WHEN c_custkey % 10 = 0 THEN concat('City@', n_name) ELSE concat('City ', n_name) END AS customer_city",
            "n_name AS customer_state",
            "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        "CASE WHEN p_size <= 5 THEN '#N/A' ELSE p_type END AS category",
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    base = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    cols = [
        "CAST(s_suppkey AS STRING) AS store_id",
        "concat('City ', n_name) AS seller_city",
        "n_name AS seller_state",
        "r_name AS region",
    ]
    # Every tenth store appears twice (full duplicates for the store audit).
    return base.selectExpr(*cols).unionByName(base.where(F.col("s_suppkey") % 10 == 0).selectExpr(*cols))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Cast before they travel, as the order lines are.
    li = _read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", f"{_QTY} AS __qty", f"{_DISC} AS __disc", "concat(l_returnflag, l_linestatus) AS __flags")
    p = _read(spark, sf_dir, "part").selectExpr("p_partkey", f"{_PRICE2} AS __price")
    base = li.join(p, li.l_partkey == p.p_partkey)
    cols = [
        "CAST(l_orderkey AS STRING) AS order_id",
        f"{_PAYMENT_TYPE} AS payment_type",
        "CAST(__qty * __price * (1 - __disc) + 0.0010 AS DECIMAL(18,4)) AS payment_value",
    ]
    # Some orders go unpaid; every twentieth order is paid twice.
    return (
        base.where(F.col("l_orderkey") % 30 != 11).selectExpr(*cols)
        .unionByName(base.where(F.col("l_orderkey") % 20 == 0).selectExpr(*cols))
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    o = _read(spark, sf_dir, "orders")
    known = li.where(F.col("l_orderkey") % 4 != 3).selectExpr(
        "CAST(l_orderkey AS STRING) AS order_id",
        "CAST(1 + l_linenumber % 5 AS DOUBLE) AS score",
    )
    unknown = o.where(F.col("o_orderkey") % 500 == 0).selectExpr(
        "concat('X', CAST(o_orderkey AS STRING)) AS order_id",
        "CAST(3 AS DOUBLE) AS score",
    )
    return known.unionByName(unknown)


@dataclass(frozen=True)
class Tables:
    """The six input tables of one run."""

    orders: DataFrame
    customers: DataFrame
    products: DataFrame
    stores: DataFrame
    payments: DataFrame
    reviews: DataFrame


#: The test tables' own dates: their orders end in 2001.
FIXTURE_PARAMS = RunParams(drop_year=2001, rfm_as_of=dt.date(2001, 12, 31), inactive_as_of=dt.date(2001, 12, 31))


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        orders=orders(spark, sf_dir),
        customers=customers(spark, sf_dir),
        products=products(spark, sf_dir),
        stores=stores(spark, sf_dir),
        payments=payments(spark, sf_dir),
        reviews=reviews(spark, sf_dir),
    )


def tables_from_paths(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> Tables:
    """Input tables from files in the declared schemas (see ``readers``)."""
    from pos360.sources.readers import read_table

    return Tables(**{name: read_table(spark, name, path, fmt) for name, path in paths.items()})


def order_date_texts(orders: DataFrame) -> DataFrame:
    """Bill dates as text in the spellings that hand-kept files mix; some are
    blank, some are no date (FIXTURES.md §2)."""
    return orders.selectExpr("order_id", f"{_DATE_TEXT} AS bill_date_text")


# Fixed values, the same expressions as in the oracle.
_VALUE_TEXTS = (
    "order_id", "customer_id", "product_id", "line_no", "channel", "delivered_store_id", "bill_date_timestamp",
    "CASE WHEN line_no = 3 THEN concat(CAST(quantity AS STRING), ' pcs') WHEN line_no = 7 THEN '' ELSE CAST(quantity AS STRING) END AS quantity",
    "CASE WHEN line_no = 4 THEN concat('USD ', CAST(mrp AS STRING)) ELSE CAST(mrp AS STRING) END AS mrp",
    "CAST(cost_per_unit AS STRING) AS cost_per_unit",
    "CASE WHEN line_no = 2 THEN 'n/a' ELSE CAST(discount AS STRING) END AS discount",
    "CASE WHEN line_no = 5 THEN replace(CAST(total_amount AS STRING), '.', ',') ELSE CAST(total_amount AS STRING) END AS total_amount",
)


def order_value_texts(orders: DataFrame) -> DataFrame:
    """Order lines with their numbers as text, as hand-kept files have them:
    with units, currencies, decimal commas, blanks (FIXTURES.md §2)."""
    return orders.selectExpr(*_VALUE_TEXTS)


def write_inputs(tables: Tables) -> Tables:
    """The six input tables written once as Parquet (shared checkpoint
    folder) and read back, so that every later job scans stored tables, as
    it would in production, instead of re-deriving the views."""
    from pos360.session import write_and_read

    return Tables(**{name: write_and_read(getattr(tables, name), f"input-{name}")
                     for name in ("orders", "customers", "products", "stores", "payments", "reviews")})
