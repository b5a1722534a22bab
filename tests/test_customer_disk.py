"""What the customer mart shuffles: amounts never travel to the catalogue, payments go by order once."""

from __future__ import annotations

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from micro import micro_tables
from pos360.operators import quality as q
from pos360.plans.catalog import Workspace, run
from pos360.plans.clean import payments_of_orders

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _nodes(df) -> list[dict]:
    return json.loads(df._jdf.queryExecution().executedPlan().toJSON())


def test_amounts_stay_from_the_catalogue(spark, no_broadcast):
    """Corrected customers: one join with products and stores together, of rows that hold sums per order."""
    nodes = _nodes(run("customer_level_360_corrected", Workspace(spark, SF_DIR)))
    joins = [json.dumps(n["leftKeys"]) for n in nodes if n["class"].endswith("SortMergeJoinExec")]
    assert sum('"__key"' in k for k in joins) == 1
    assert not [k for k in joins if '"delivered_store_id"' in k]


@pytest.mark.parametrize("key", ["customer_level_360_corrected", "order_level_enriched", "customer_payment_summary", "store_top_payment"])
def test_payments_travel_by_order_alone(spark, no_broadcast, key):
    """Equal payments are of one order: no shuffle by all columns before the one by order."""
    sent = [json.dumps(n["outputPartitioning"]) for n in _nodes(run(key, Workspace(spark, SF_DIR))) if n["class"].endswith("ShuffleExchangeExec")]
    assert sent and not [e for e in sent if '"payment_value"' in e]


def test_payments_of_orders_are_the_cleaned_ones(spark):
    raw = micro_tables(spark)
    raw = replace(raw, payments=raw.payments.unionByName(raw.payments.withColumn("order_id", F.lit(None).cast("string"))))
    whole = q.clean_payment_duplicates(q.clean_round_payments(raw.payments)).where("order_id is not null")
    assert sorted(map(repr, payments_of_orders(raw).collect())) == sorted(map(repr, whole.collect()))
