"""Session helpers: a local session for tests and benchmarks, and lineage cuts
through the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "16g",
                  app_name: str = "pos360") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def join_in_place(spark: SparkSession) -> None:
    """Let a join on (order, customer, product) use inputs that are both
    partitioned by the order alone. By default Spark shuffles both again by
    all keys; the cleaning chain would then send every line three more times."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder named by the session (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a fresh temporary folder (as
    in tests); on a cluster the setting must name a shared folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pos360-ckpt-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/pos360/{name}-{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it
    back: the lineage is cut, and later reads get column pruning, filter
    pushdown and file statistics (unlike an RDD checkpoint)."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_written_tables(spark: SparkSession) -> None:
    """Delete the tables this application wrote with ``write_and_read`` (its
    ``pos360/`` folder inside its own checkpoint directory), through the
    Hadoop FileSystem API so it works on any shared file system."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        return
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/pos360")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def cluster_conf(total_cores: int) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1000 executors over ~100 TB):
    AQE picks the partition count at run time from an initially generous
    one, splits skewed join partitions and converts joins to broadcast only
    when runtime sizes are below the threshold."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(max(200, total_cores * 4)),
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
