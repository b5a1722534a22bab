"""Published marts: reports on them equal the lazy ones; a year-bounded
report prunes the order mart's year partitions."""

from __future__ import annotations

import pytest

from oracle_compare import digest
from pos360.plans import trends
from pos360.plans.catalog import Workspace, run
from pos360.plans.publish import current_version, orders_between_years, publish_marts, read_marts

SF_DIR = "/root/testdata/sf0.001"


def test_published_marts_serve_the_same_reports(spark, tmp_path):
    w = Workspace(spark, SF_DIR)
    publish_marts(w, str(tmp_path))
    marts = read_marts(spark, str(tmp_path))
    on_disk = Workspace(spark, SF_DIR, marts=marts)
    for key in ("kpi_overview", "region_trend", "rfm_segment_counts", "kpi_top_store", "cohort_retention"):
        a, b = run(key, w), run(key, on_disk)
        assert digest(a.columns, a.collect()) == digest(b.columns, b.collect()), key


def test_year_bounded_report_prunes_partitions(spark, tmp_path):
    publish_marts(Workspace(spark, SF_DIR), str(tmp_path))
    om = read_marts(spark, str(tmp_path))["order"]
    df = trends.category_month_trend(orders_between_years(om, 1996, 1997))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    years = {r.year for r in df.select("year").distinct().collect()}
    assert years == {1996, 1997}


class _Broken(Workspace):
    """Fails when its third mart is written."""

    def building(self):
        return self

    @property
    def store_mart(self):
        raise RuntimeError("lost")


def test_a_failed_publication_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path / "marts")
    with pytest.raises(FileNotFoundError):
        read_marts(spark, base)
    publish_marts(Workspace(spark, SF_DIR), base)
    first = current_version(spark, base)
    before = read_marts(spark, base)
    with pytest.raises(RuntimeError, match="lost"):
        publish_marts(_Broken(spark, SF_DIR), base)
    assert current_version(spark, base) == first and len(list((tmp_path / "marts/versions").iterdir())) == 2
    assert {k: v.count() for k, v in read_marts(spark, base).items()} == {k: v.count() for k, v in before.items()}
    # A workspace publishes the marts that it reads; the old version stays for its readers, the broken one goes.
    publish_marts(Workspace(spark, SF_DIR, marts=before), base)
    second = current_version(spark, base)
    assert second != first and {p.name for p in (tmp_path / "marts/versions").iterdir()} == {first, second}
    again = read_marts(spark, base)
    for k in before:
        columns = sorted(before[k].columns)
        assert digest(columns, again[k].select(columns).collect()) == digest(columns, before[k].select(columns).collect())
    publish_marts(Workspace(spark, SF_DIR, marts=again), base)
    assert {p.name for p in (tmp_path / "marts/versions").iterdir()} == {second, current_version(spark, base)}
    assert read_marts(spark, base, second)["store"].count() == again["store"].count()
