"""Operator 9, sharding: a uniform shuffle into shards of exact sizes.

Blocks of input rows, dealt by a hash of their number, are the source side. A communication matrix
says how many rows of each block go to each shard; its rows are drawn one
after the other from the multivariate hypergeometric law, by recursive halving
of the shards, which is the law that a uniform permutation of all rows would
give. Each block is permuted by random keys, the cut positions of its matrix row deal it out, and the shards
are permuted again. Every step but the draw of the small matrix is a
DataFrame expression."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pos360.llm.tables import read_table, written

BLOCK_ROWS = 1 << 16  # rows aimed at in each block
MOST_BLOCKS = 10_000  # the driver draws a row of the matrix for each; larger tables have larger blocks
BUCKET_ROWS = 50_000  # rows aimed at in each sorted bucket of a shard
SHARDS = 16


def hypergeometric(good: int, bad: int, n: int, rng: np.random.Generator) -> int:
    """How many of n rows, drawn from good + bad ones, are good; numpy's own sampler stops at 10^9 rows.

    Inversion: probabilities around the mode, by their ratios, as far as they
    are not far below what a uniform double can tell from 0."""
    least, most, total = max(0, n - bad), min(n, good), good + bad
    if least == most:
        return least
    mode = min(max((n + 1) * (good + 1) // (total + 2), least), most)
    reach = 50 + math.ceil(10 * math.sqrt(n * (good / total) * (bad / total) * ((total - n) / (total - 1))))
    first, last = max(least, mode - reach), min(most, mode + reach)
    x = np.arange(first, last, dtype=np.float64)
    up = (good - x) * (n - x) / ((x + 1) * (float(bad - n) + x + 1))  # p(x + 1) / p(x)
    below, above = 1 / up[: mode - first], up[mode - first :]
    weight = np.concatenate([np.cumprod(below[::-1])[::-1], [1.0], np.cumprod(above)])
    upto = np.cumsum(weight)
    return first + min(int(np.searchsorted(upto, rng.random() * upto[-1], "right")), last - first)


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows from each block to each shard: row sums are block_rows, column sums
    differ by one at most. The extra rows go to shards drawn at random. A block
    is dealt to halves of the shards, to halves of these, and so on; any number
    of rows that an int64 holds will do."""
    rng = np.random.default_rng(seed)
    total = sum(block_rows)
    left = np.full(shards, total // shards, np.int64)
    left[rng.permutation(shards)[: total % shards]] += 1
    out = []
    for n in block_rows:
        row = np.zeros(shards, np.int64)
        halves = [(0, shards, n)]
        while halves:
            start, end, rows = halves.pop()
            if end - start == 1:
                row[start] = rows
            elif rows:
                middle = (start + end) // 2
                lower = hypergeometric(int(left[start:middle].sum()), int(left[middle:end].sum()), rows, rng)
                halves += [(start, middle, lower), (middle, end, rows - lower)]
        left -= row
        out.append(row.tolist())
    return out


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = 20_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per input row.

    Defined cases: null texts count as empty (size 1, CRC 0), null and repeated
    ids and equal rows are rows like any other, an empty table gives none, other
    columns of the input are ignored. A row's block follows from its number in
    the input, so no key of the data decides how much a task gets. The narrow rows are written once with their random keys:
    a lost executor reads the same rows and keys again.

    The driver holds the matrix: blocks x shards small numbers, MOST_BLOCKS
    blocks at most."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    number = F.monotonically_increasing_id()
    narrow = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            number.alias("row"),
        ).select("*", F.xxhash64("row", F.lit(seed)).alias("first_key"), F.xxhash64(F.lit(seed + 1), "row").alias("second_key")),
        "sharding",
    )
    n_blocks = min(MOST_BLOCKS, max(1, -(-narrow.count() // BLOCK_ROWS)))
    narrow = narrow.withColumn("block", F.pmod(F.xxhash64("row", F.lit(seed + 2)), F.lit(n_blocks)))
    blocks = [(r["block"], r["n"]) for r in narrow.groupBy("block").agg(F.count(F.lit(1)).alias("n")).orderBy("block").collect()]
    drawn = communication_matrix([n for _, n in blocks], shards, seed)
    cuts = [(b, np.cumsum(row).tolist()) for (b, _), row in zip(blocks, drawn)]
    matrix = spark.createDataFrame(cuts, "block long, cuts array<long>")
    rank = F.row_number().over(Window.partitionBy("block").orderBy("first_key", "row"))
    buckets = max(1, -(-sum(n for _, n in blocks) // (shards * BUCKET_ROWS)))
    dealt = (
        narrow.withColumn("rank", rank)
        .join(matrix, "block")
        .withColumn("shard", F.size(F.filter("cuts", lambda c: c < F.col("rank"))).cast("int"))
        .withColumn("bucket", F.floor((F.shiftrightunsigned("second_key", 1) / F.lit(2.0**63)) * buckets).cast("int"))
        .withColumn("bucket", F.least("bucket", F.lit(buckets - 1)))
        .drop("cuts", "rank", "block", "first_key")
    )
    per_bucket = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("second_key", "row"))
    return (
        dealt.withColumn("within", within)
        .join(offsets, ["shard", "bucket"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            (F.col("base") + F.col("within") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op9_hypergeometric_shards(spark, sf_dir: str) -> DataFrame:
    return shard_rows(read_table(spark, sf_dir, "documents"))
