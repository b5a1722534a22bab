"""Publishing the three marts as Parquet tables (the original inserts them
into stored tables that every report then reads).

A publication is a new folder ``versions/<version>`` with all three marts. Only
when every one of them is written does the pointer file ``CURRENT`` name it,
by one rename that replaces the old pointer. A reader asks the pointer once and
then reads one version: it never sees two publications mixed, and a job that
fails halfway leaves the old version in place (its own folder is removed by the
next publication). So a workspace may also read the marts that it publishes anew.

The order mart, read by most reports, is partitioned by the order's year:
a report restricted to a date range reads only the matching folders
(``PartitionFilters`` in the scan). Marts are written whole, never
appended (D19: re-running gives the same tables).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pos360.plans.catalog import Workspace

MART_NAMES = ("customer_level_360", "order_level_360", "store_level_360")
ORDER_PARTITION = "order_year"
POINTER = "CURRENT"


class _Store:
    """Files of a base folder on whatever file system Hadoop finds for it."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.base = base.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def text(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file beside ``name`` and rename it over it."""
        folder, _, last = name.rpartition("/")
        fresh = self.path(f"{folder}/.{last}-{uuid.uuid4().hex}".lstrip("/"))
        stream = self.fs.create(fresh, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self.conf).rename(fresh, self.path(name), options)

    def folders(self, name: str) -> list[str]:
        if not self.fs.exists(self.path(name)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name)) if s.isDirectory())

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def current_version(spark: SparkSession, base_path: str) -> str | None:
    """The version that readers get, None before the first publication."""
    return _Store(spark, base_path).text(POINTER)


def _paths(base_path: str, version: str) -> dict[str, str]:
    return {name: f"{base_path.rstrip('/')}/versions/{version}/{name}" for name in MART_NAMES}


def publish_marts(w: Workspace, base_path: str, keep: int = 2) -> dict[str, str]:
    """Write the three marts as a new version and make it the current one.

    The last ``keep`` versions that were current stay for their readers; older
    ones and those that never became current are removed. One publisher at a
    time. Returns the paths of the new marts."""
    w = w.building()
    store = _Store(w.spark, base_path)
    before = store.text(POINTER)
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    paths = _paths(base_path, version)
    w.customer_mart.write.parquet(paths["customer_level_360"])
    (
        w.order_mart.withColumn(ORDER_PARTITION, F.year("order_date"))
        .write.partitionBy(ORDER_PARTITION).parquet(paths["order_level_360"])
    )
    w.store_mart.write.parquet(paths["store_level_360"])
    store.replace(f"versions/{version}/PUBLISHED", version)
    store.replace(POINTER, version)
    published = [v for v in store.folders("versions") if store.text(f"versions/{v}/PUBLISHED")]
    stay = {version, before, *published[-keep:]}
    for v in store.folders("versions"):
        if v not in stay:
            store.delete(f"versions/{v}")
    return paths


def read_marts(spark: SparkSession, base_path: str, version: str | None = None) -> dict[str, DataFrame]:
    """The published marts, keyed ``customer``, ``order``, ``store`` (the
    form ``Workspace(marts=...)`` takes): all three of one version, the current
    one unless another is named."""
    version = version or current_version(spark, base_path)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {base_path}")
    paths = _paths(base_path, version)
    return {name.split("_")[0]: spark.read.parquet(paths[name]) for name in MART_NAMES}


def orders_between_years(om: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Order-mart lines of the given years; on a published mart the filter
    is on the partition column, so other years are never read."""
    if ORDER_PARTITION in om.columns:
        return om.where(F.col(ORDER_PARTITION).between(first_year, last_year))
    return om.where(F.year("order_date").between(first_year, last_year))
