"""Benchmark of the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Phases (every result goes to the ``noop`` sink: full evaluation, no output
I/O; a query's time is the median of ``$BENCH_RUNS`` runs after a warm-up):

1. ``write_inputs``: the six stand-in input tables (orders, customers,
   products, stores, payments, reviews) are derived from the test tables
   once and written as Parquet, as stored tables would be in production.
2. Headline queries on those inputs (cleaning + mart + report, each
   planned whole). ``value`` is the sum of these.
3. ``write_three_marts`` and ``*_on_marts``: the marts written once, then
   reports read them (how the marts are shared by many reports).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pos360.functions.columns import money_to_double  # noqa: E402
from pos360.operators.ranking import sort_columns  # noqa: E402
from pos360.plans import kpi, rfm, trends  # noqa: E402
from pos360.plans.catalog import Workspace, run  # noqa: E402
from pos360.session import drop_written_tables, local_session, write_and_read  # noqa: E402
from pos360.sources.fixtures import FIXTURE_PARAMS, fixture_tables, write_inputs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SHUFFLE_PARTITIONS = max(8, CPUS * 2)

HEADLINE = (
    "clean_orders",
    "customer_level_360",
    "order_level_enriched",
    "store_level_360",
    "kpi_overview",
    "category_month_trend",
    "rfm_segments",
)


def _sf_of(path: str) -> float | str:
    name = os.path.basename(path)
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def _time(build) -> float:
    """Median wall time of building + fully evaluating a DataFrame."""
    def once() -> float:
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    once()  # warm-up: JIT, file listing, broadcast of small tables
    return statistics.median(once() for _ in range(RUNS))


def builtin_scores(cm):
    """The three scores by Spark's own ntile, every row in one task: only for comparison."""
    df = rfm.rfm_base(cm, FIXTURE_PARAMS)
    for order, col in ((rfm.RECENCY_ORDER, "r"), (rfm.FREQUENCY_ORDER, "f"), (rfm.MONETARY_ORDER, "m")):
        df = df.withColumn(col, F.ntile(4).over(Window.orderBy(*sort_columns(order))))
    return df


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=SHUFFLE_PARTITIONS, app_name="pos360-bench")
    results: dict[str, float] = {}

    t = time.perf_counter()
    inputs = write_inputs(fixture_tables(spark, SF_DIR))
    results["write_inputs"] = round(time.perf_counter() - t, 3)

    for key in HEADLINE:
        results[key] = round(_time(lambda k=key: run(k, Workspace(spark, raw=inputs, params=FIXTURE_PARAMS))), 3)

    # Spark's own single-partition ntile, for comparison with rfm_segments.
    results["rfm_scores_builtin_ntile"] = round(_time(
        lambda: builtin_scores(Workspace(spark, raw=inputs, params=FIXTURE_PARAMS).customer_mart)), 3)

    w = Workspace(spark, raw=inputs, params=FIXTURE_PARAMS, write_clean_orders=True)
    t = time.perf_counter()
    marts = {
        "customer": write_and_read(w.customer_mart, "bench-customer-mart"),
        "order": write_and_read(w.order_mart, "bench-order-mart"),
        "store": write_and_read(w.store_mart, "bench-store-mart"),
    }
    results["write_three_marts"] = round(time.perf_counter() - t, 3)
    on_marts = {
        "kpi_overview_on_marts": lambda: kpi.kpi_overview(marts["order"], FIXTURE_PARAMS),
        "category_month_trend_on_marts": lambda: trends.category_month_trend(marts["order"]),
        "region_trend_on_marts": lambda: trends.region_trend(marts["order"]),
        "rfm_segments_on_marts": lambda: rfm.rfm_segments(marts["customer"], FIXTURE_PARAMS),
    }
    for key, build in on_marts.items():
        results[key] = round(_time(lambda b=build: money_to_double(b())), 3)

    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(results[k] for k in HEADLINE), 3),
        "unit": "sec",
        "queries": results,
        "sf": _sf_of(SF_DIR),
        "cpus": CPUS,
        "runs": RUNS,
        "shuffle_partitions": SHUFFLE_PARTITIONS,
        "note": "value = sum of the headline queries on the written input tables; "
                "median of runs after one warm-up; noop sink",
    }))
    drop_written_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
