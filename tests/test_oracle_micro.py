"""Every registered query on the hand-made micro tables against the DuckDB
oracle (the micro tables stand in for the fixture views)."""

from __future__ import annotations

import duckdb
import pytest

from micro import micro_tables
from oracle_compare import compare, first_difference
from pos360.oracle.sql import KEYS, statement
from pos360.plans.catalog import Workspace, run
from pos360.sources.fixtures import FIXTURE_PARAMS


@pytest.fixture(scope="module")
def micro_env(spark, tmp_path_factory):
    raw = micro_tables(spark)
    d = tmp_path_factory.mktemp("micro")
    con = duckdb.connect()
    for name in ("orders", "customers", "products", "stores", "payments", "reviews"):
        path = str(d / name)
        getattr(raw, name).coalesce(1).write.mode("overwrite").parquet(path)
        con.execute(f"CREATE VIEW f_{name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    # Fresh reads from the written files, the same input DuckDB sees.
    from pos360.sources.fixtures import Tables

    tables = Tables(**{n: spark.read.parquet(str(d / n)) for n in
                       ("orders", "customers", "products", "stores", "payments", "reviews")})
    return tables, con


@pytest.mark.parametrize("key", KEYS)
def test_micro_matches_oracle(spark, micro_env, key):
    tables, con = micro_env
    df = run(key, Workspace(spark, raw=tables, params=FIXTURE_PARAMS))
    sql = statement(key, with_fixtures=False)
    r = compare(df, con, sql)
    assert r["ok"], (r, first_difference(df, con, sql))
