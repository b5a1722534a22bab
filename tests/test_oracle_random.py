"""Seeded random input tables (NULLs, repeated ids, duplicate rows, text ids)
through the marts and RFM, against the DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pytest

from oracle_compare import compare, first_difference
from pos360.oracle.sql import KEYS as ALL_KEYS
from pos360.oracle.sql import statement
from pos360.plans.catalog import Workspace, run
from pos360.sources.fixtures import FIXTURE_PARAMS, Tables
from pos360.sources.schema import SCHEMAS

KEYS = ("clean_orders", "customer_level_360", "order_level_enriched", "store_level_360", "rfm_segments",
        "customer_level_360_corrected", "store_level_360_corrected", "kpi_overview")


def _money(rnd: random.Random, lo: int = 1, hi: int = 500) -> Decimal:
    return Decimal(rnd.randint(lo * 10000, hi * 10000)) / 10000


def _tables(rnd: random.Random) -> dict[str, list]:
    def maybe(v, p=0.05):
        return None if rnd.random() < p else v

    cust_ids = ["1", "2", "3", "03", "4", "5", "G-1", "7"]
    orders = []
    for o in range(60):
        cid = maybe(rnd.choice(cust_ids))
        day = dt.datetime(rnd.choice([1999, 2000, 2001]), rnd.randint(1, 12), rnd.randint(1, 28))
        for line in range(rnd.randint(1, 4)):
            q = maybe(rnd.randint(1, 5))
            mrp, cost = _money(rnd), _money(rnd)
            disc = _money(rnd, 0, 20)
            orders.append((maybe(f"o{o}", 0.02), cid, maybe(f"p{rnd.randint(1, 8)}"), line + 1,
                           rnd.choice(["Online", "Phone", "Instore"]), maybe(f"s{rnd.randint(1, 5)}"),
                           maybe(day), q, mrp, cost, disc, _money(rnd, 1, 2000)))
    customers = [(int(c), maybe(f"C{c}@"), f"S{int(c) % 3}", maybe(rnd.choice("FM"))) for c in
                 ["1", "2", "3", "4", "5", "7", "7"]]
    products = [(f"p{i}", maybe(rnd.choice(["A", "B", "#N/A"]))) for i in range(1, 9)] + [("p1", "Z")]
    stores = [(f"s{i}", f"City{i % 3}", f"St{i % 2}", maybe("R1")) for i in range(1, 6)] + [("s2", "Other", "St0", "R2")]
    payments = [(f"o{rnd.randint(0, 70)}", maybe(rnd.choice(["UPI", "Voucher", "Credit Card", "Debit Card"])),
                 _money(rnd, 1, 3000)) for _ in range(70)]
    reviews = [(maybe(f"o{rnd.randint(0, 70)}"), float(rnd.randint(1, 5))) for _ in range(60)]
    return {"orders": orders, "customers": customers, "products": products, "stores": stores,
            "payments": payments, "reviews": reviews}


@pytest.fixture(scope="module", params=[11, 23, 57])
def random_env(request, spark, tmp_path_factory):
    rows = _tables(random.Random(request.param))
    d = tmp_path_factory.mktemp(f"random{request.param}")
    con = duckdb.connect()
    tables = {}
    for name, data in rows.items():
        path = str(d / name)
        spark.createDataFrame(data, SCHEMAS[name]).coalesce(1).write.parquet(path)
        con.execute(f"CREATE VIEW f_{name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
        tables[name] = spark.read.parquet(path)
    return Tables(**tables), con


@pytest.mark.parametrize("key", KEYS)
def test_random_tables_match_oracle(spark, random_env, key):
    tables, con = random_env
    df = run(key, Workspace(spark, raw=tables, params=FIXTURE_PARAMS))
    sql = statement(key, with_fixtures=False)
    r = compare(df, con, sql)
    assert r["ok"], (r, first_difference(df, con, sql))


@pytest.fixture(scope="module")
def random_env_all(spark, tmp_path_factory):
    rows = _tables(random.Random(23))
    d = tmp_path_factory.mktemp("random-all")
    con = duckdb.connect()
    tables = {}
    for name, data in rows.items():
        path = str(d / name)
        spark.createDataFrame(data, SCHEMAS[name]).coalesce(1).write.parquet(path)
        con.execute(f"CREATE VIEW f_{name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
        tables[name] = spark.read.parquet(path)
    return Tables(**tables), con


@pytest.mark.parametrize("key", ALL_KEYS)
def test_every_query_on_random_tables(spark, random_env_all, key):
    tables, con = random_env_all
    df = run(key, Workspace(spark, raw=tables, params=FIXTURE_PARAMS))
    sql = statement(key, with_fixtures=False)
    r = compare(df, con, sql)
    assert r["ok"], (r, first_difference(df, con, sql))
