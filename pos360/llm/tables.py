"""Inputs, settings and written tables that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pos360.session import shared_path

# Text bytes that a Python task works on at a time.
PIECE_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string), whatever other columns there are; null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def packed(docs: DataFrame) -> DataFrame:
    """(row, text): every row whole in one column, so that no added name can clash with its own, and its text; null text is empty."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder and read back: cuts the lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def give_back() -> None:
    """Return this worker's freed memory to the system: a worker waits for its
    next task with all that its largest arrays once took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `size` bytes in a column (a longer text alone).

    Spark's batches are counted in rows; the arrays that a text is taken apart
    into are many times its size, so memory follows the bytes of a slice."""
    for b in batches:
        length = pc.fill_null(pc.binary_length(b[column]), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(length.tolist()):
            if total and total + n > size:
                yield b.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < b.num_rows:
            yield b.slice(start)
        give_back()
