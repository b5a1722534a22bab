"""What the store mart shuffles: a store's rows combine before they are merged, no line is copied."""

from __future__ import annotations

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from micro import micro_tables
from pos360.plans.catalog import Workspace, run
from pos360.plans.store_mart import _PARTS, _per_value, store_level_360
from pos360.sources.fixtures import FIXTURE_PARAMS

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


@pytest.mark.parametrize("key", ["store_level_360", "store_level_360_corrected"])
def test_store_mart_expands_no_lines(spark, no_broadcast, key):
    """Distinct counts come from one row per store and value, in parts that add up: no copies of wide rows, and no
    shuffle by store and value, which leaves as many rows as lines to the merge by store."""
    nodes = _nodes(run(key, Workspace(spark, SF_DIR)))
    assert not [n for n in nodes if n["class"].endswith("ExpandExec")]
    sent = [json.dumps(n["outputPartitioning"]) for n in nodes if n["class"].endswith("ShuffleExchangeExec")]
    assert not [e for e in sent if '"store_id"' in e and any(f'"{c}"' in e for c in ("product_id", "customer_id", "__day"))]
    assert sum('"__part"' in e for e in sent) == 4  # goods, customers, days, categories


def test_a_store_is_more_than_one_task(spark, no_broadcast):
    """The values of a single store lie in several partitions, each value in one."""
    lines = spark.range(4000).select(F.lit("s").alias("store_id"), (F.col("id") % 1000).cast("string").alias("customer_id"))
    out = _per_value(lines, "customer_id", F.count("store_id").alias("n")).withColumn("p", F.spark_partition_id())
    rows = out.collect()
    assert len(rows) == 1000 and {r["n"] for r in rows} == {4}
    assert len({r["p"] for r in rows}) > 3 and len({r["__part"] for r in rows}) == _PARTS


def test_payment_types_are_any_text(spark):
    """Types with quotes, brackets and NULL are counted as they are."""
    w = Workspace(spark, raw=micro_tables(spark), params=FIXTURE_PARAMS)
    odd = '[{"type":"x",\\n"é'
    kind = F.when(F.col("payment_type") == "Credit Card", F.lit(None)).when(F.col("payment_type") == "UPI", F.lit(odd)).otherwise(F.col("payment_type"))
    clean = replace(w.clean, payments=w.clean.payments.withColumn("payment_type", kind))
    got = {r[0]: r[1] for r in store_level_360(clean, FIXTURE_PARAMS, ("store_id", "most_common_payment_type")).collect()}
    per = (
        clean.orders.join(clean.payments, "order_id").groupBy(F.col("delivered_store_id").alias("store_id"), "payment_type").count()
        .orderBy("store_id", F.desc("count"), F.asc_nulls_first("payment_type")).collect()
    )
    expected = {}
    for r in per:
        expected.setdefault(r["store_id"], r["payment_type"])
    assert odd in expected.values() and all(got[s] == t for s, t in expected.items() if s is not None)
