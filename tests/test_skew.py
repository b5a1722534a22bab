"""Hot and missing keys: no task of a mart's joins gets far more lines than the others."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pos360.plans.order_mart import _look_up, _spread, order_level_enriched
from pos360.plans.catalog import Workspace

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


def test_lines_without_a_key_spread(spark, no_broadcast):
    """60 % of the lines have no customer; after the join they lie in all partitions alike."""
    lines = spark.range(20_000).select("id", F.when(F.col("id") % 5 < 2, F.col("id") % 1000).alias("custid"))
    dim = spark.range(1000).select(F.col("id").alias("custid"), (F.col("id") * 2).alias("twice"))
    out = _look_up(_spread(lines, ("custid",)), dim, "custid")
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.5 * min(sizes)
    assert out.where("custid is null and twice is not null").isEmpty() and out.where("custid is not null").where("twice <> 2 * custid or twice is null").isEmpty()


def test_order_mart_of_guests(spark, no_broadcast):
    """Six of ten orders are guests': no line is lost, even partitions."""
    w = Workspace(spark, SF_DIR)
    guest = F.pmod(F.xxhash64("order_id"), F.lit(10)) < 6
    clean = replace(w.clean, orders=w.clean.orders.withColumn("customer_id", F.when(~guest, F.col("customer_id"))))
    out = order_level_enriched(clean, w.params)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == clean.orders.count() and max(sizes) < 2.5 * (sum(sizes) / 8)
