"""The corpus pipeline: documents through five stages, each by one operator.

quality classifier -> SimHash near-dedup -> suffix-array dedup -> benchmark
decontamination -> SentencePiece encoding. A stage gets what its predecessor
kept, written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pos360.llm.decontaminate import remove_contaminated
from pos360.llm.quality_gbt import keep_good
from pos360.llm.sentencepiece_codec import encode_texts
from pos360.llm.simhash import one_of_each
from pos360.llm.suffix_dedup import dedup_bytes
from pos360.llm.tables import read_table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts good."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that an earlier one has; n_chars follows the text.

    A character that loses some of its bytes goes whole. A document of which
    nothing is left stays as an empty text."""
    found = dedup_bytes(docs, keep_rest=True)
    own = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return found.select([own.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no large share of benchmark passages."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids."""
    return encode_texts(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL has neither boosted trees nor XXH64 nor Viterbi paths; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
