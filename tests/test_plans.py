"""Plan shape guards over every registered query (scale properties that a
small result cannot show): no cross joins, no window over all rows except
the bounded ones, no window at all in the order-cleaning chain."""

from __future__ import annotations

import json

import pytest

from pos360.plans.catalog import KEYS, Workspace, run
from pos360.sources.fixtures import FIXTURE_PARAMS, fixture_tables, write_inputs

SF_DIR = "/root/testdata/sf0.001"
RFM = ("rfm_scores", "rfm_segments", "rfm_segment_counts", "rfm_segments_corrected", "segment_performance")

# Unpartitioned windows that are bounded by construction: the seasonality
# ratio (at most 12 month rows) and the catalogue's categories.
BOUNDED_GLOBAL_WINDOWS = {"seasonality_index", "cross_sell_pairs"}


def _nodes(df):
    plan = df._jdf.queryExecution().executedPlan()
    return json.loads(plan.toJSON())


@pytest.fixture(scope="module")
def no_aqe(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(spark, no_aqe, key):
    nodes = _nodes(run(key, Workspace(spark, SF_DIR)))
    classes = [n["class"].rsplit(".", 1)[-1] for n in nodes]
    assert "CartesianProductExec" not in classes
    assert "BroadcastNestedLoopJoinExec" not in classes
    for n in nodes:
        if n["class"].endswith("WindowExec") and not n.get("partitionSpec"):
            assert key in BOUNDED_GLOBAL_WINDOWS, f"{key}: window over all rows"
    if key.startswith("clean_") or key.startswith("audit_"):
        assert "WindowExec" not in classes or key == "clean_store_duplicates", key


@pytest.mark.parametrize("key", [k for k in RFM if k != "segment_performance"])
def test_scores_are_comparisons(spark, no_aqe, key):
    """No window, sort, join or range exchange of customers: a score compares with literal keys."""
    classes = [n["class"].rsplit(".", 1)[-1] for n in _nodes(run(key, Workspace(spark, SF_DIR)))]
    assert not {"WindowExec", "SortExec", "SortMergeJoinExec", "BroadcastHashJoinExec"} & set(classes)
    assert classes.count("ShuffleExchangeExec") == (1 if key == "rfm_segment_counts" else 0)


@pytest.fixture(scope="module")
def inputs(spark):
    return write_inputs(fixture_tables(spark, SF_DIR))


@pytest.mark.parametrize("key", ["clean_orders", "order_level_enriched"])
def test_lines_are_scanned_twice_at_most(spark, no_aqe, inputs, key):
    """The two group statistics of the cleaning chain share one scan and shuffle."""
    nodes = _nodes(run(key, Workspace(spark, raw=inputs, params=FIXTURE_PARAMS)))
    scans = [n for n in nodes if n["class"].endswith("FileSourceScanExec") and "bill_date_timestamp" in json.dumps(n["output"])]
    reused = [n for n in nodes if n["class"].endswith("ReusedExchangeExec")]
    assert len(scans) <= 2 and reused


MARTS = ("customer_level_360", "store_level_360", "customer_level_360_corrected", "store_level_360_corrected")


@pytest.mark.parametrize("key", [k for k in KEYS if k not in MARTS and k not in RFM])
def test_reports_write_nothing(spark, monkeypatch, key):
    def refuse(*_):
        raise AssertionError(f"{key} writes a table")

    monkeypatch.setattr("pos360.plans.catalog.write_and_read", refuse)
    run(key, Workspace(spark, SF_DIR))


@pytest.mark.parametrize("key, scans", [("kpi_stores", 2), ("kpi_locations", 2), ("kpi_regions", 2), ("kpi_top_store", 2), ("new_customers_by_month", 4), ("kpi_retention_rate", 4)])
def test_one_figure_reads_the_lines_as_the_cleaning_does(spark, no_aqe, inputs, key, scans):
    """No aggregate of the mart is planned but the wanted ones: the cleaning's two scans of the lines for each, none
    of the payments. Customers need sums and distinct counts: rows of '7' and '007' are one if all of these agree."""
    nodes = _nodes(run(key, Workspace(spark, raw=inputs, params=FIXTURE_PARAMS)))
    outputs = [json.dumps(n["output"]) for n in nodes if n["class"].endswith("FileSourceScanExec")]
    lines = [o for o in outputs if "bill_date_timestamp" in o or '"customer_id"' in o]
    assert len(lines) <= scans and not any("payment_type" in o for o in outputs)


def test_all_dimensions_in_one_scan_of_the_mart(spark, no_aqe, tmp_path):
    from pos360.plans.trends import sales_by_dimension

    path = str(tmp_path / "om")
    Workspace(spark, SF_DIR).order_mart.write.parquet(path)
    nodes = _nodes(sales_by_dimension(spark.read.parquet(path)))
    classes = [n["class"].rsplit(".", 1)[-1] for n in nodes]
    assert classes.count("FileSourceScanExec") == 1 and classes.count("ExpandExec") == 1
