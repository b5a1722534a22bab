"""Every registered query on the sf0.001 test tables against its oracle SQL
(the driver runs the same check at sf0.01)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck_connect, first_difference
from pos360.oracle.sql import all_statements
from pos360.plans.catalog import KEYS

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_DIR)


def test_registry_and_oracle_keys_agree():
    assert set(KEYS) == set(all_statements())
    assert set(KEYS) <= set(entry.queries()) and set(KEYS) <= set(entry.oracle_sql())


# Spark type -> DuckDB type of the same column.
TYPES = {"StringType": "VARCHAR", "LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
         "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "BooleanType": "BOOLEAN"}


@pytest.mark.parametrize("key", KEYS)
def test_fixture_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_DIR)
    sql = entry.oracle_sql()[key]
    r = compare(df, con, sql)
    assert r["ok"], (r, first_difference(df, con, sql))
    duck_types = {row[0]: row[1] for row in con.execute("DESCRIBE " + sql).fetchall()}
    for f in df.schema.fields:
        spark_type = type(f.dataType).__name__
        assert duck_types[f.name] == TYPES.get(spark_type, spark_type), (key, f.name)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["customer_segment", "customer_count"]
    rows = df.collect()
    assert sum(r.customer_count for r in rows) > 0
