"""RFM segmentation over the customer mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pos360.operators.ranking import ntile_by_cut_keys
from pos360.params import DEFAULT, RunParams
from pos360.session import write_and_read

# Total-score bands of the segments (for four tiles).
SEGMENTS = (
    (3, 6, "At Risk Customers"),
    (7, 9, "Loyal Customers"),
    (10, 12, "Best Customers"),
)
UNDEFINED_SEGMENT = "Undefined"

# Orderings of the three scores, each made total by the customer id and then
# the remaining columns.
RECENCY_ORDER = (("recency", True), ("custid", True), ("frequency", True), ("monetary", True))
FREQUENCY_ORDER = (("frequency", False), ("custid", True), ("recency", True), ("monetary", True))
MONETARY_ORDER = (("monetary", False), ("custid", True), ("recency", True), ("frequency", True))


def rfm_base(cm: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Distinct (customer, last date, frequency, monetary) with recency in
    days up to ``params.rfm_as_of``."""
    return (
        cm.select("custid", "last_transaction_date", "frequency", "monetary")
        .distinct()
        .select(
            "custid",
            F.datediff(F.lit(params.rfm_as_of), F.col("last_transaction_date")).alias("recency"),
            "frequency",
            "monetary",
        )
    )


def rfm_recency(cm: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """F1."""
    return rfm_base(cm, params).select("custid", "recency")


def rfm_scores(cm: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """F2: three NTILE scores and the concatenated segment code.

    The customer-grain base is written once, since the selection of the tiles'
    last keys reads it a few times; each score is then a comparison with three
    keys (``ranking.ntile_by_cut_keys``).
    Reference (D10): score = tile, so the best customers get 1. Corrected:
    score = tiles + 1 - tile."""
    k = params.rfm_tiles
    base = write_and_read(rfm_base(cm, params), "rfm-base")
    scored = ntile_by_cut_keys(base, k, {
        "recency_score": RECENCY_ORDER, "frequency_score": FREQUENCY_ORDER, "monetary_score": MONETARY_ORDER})
    if params.corrected:
        scored = scored.withColumns({
            c: (F.lit(k + 1) - F.col(c)).cast("int") for c in ("recency_score", "frequency_score", "monetary_score")
        })
    return scored.select(
        "custid", "recency", "recency_score", "frequency", "frequency_score", "monetary", "monetary_score",
        F.concat(
            F.col("recency_score").cast("string"), F.col("frequency_score").cast("string"),
            F.col("monetary_score").cast("string"),
        ).alias("rfm_segment"),
    )


def segment_of(total: F.Column) -> F.Column:
    expr = None
    for lo, hi, name in SEGMENTS:
        cond = total.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(UNDEFINED_SEGMENT))


def rfm_segments(cm: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """total score and segment name."""
    s = rfm_scores(cm, params)
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return s.select(
        "custid", "recency", "recency_score", "frequency", "frequency_score", "monetary", "monetary_score",
        total.alias("total_score"), segment_of(total).alias("customer_segment"),
    )


def rfm_segment_counts(cm: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """customers per segment."""
    return (
        rfm_segments(cm, params)
        .groupBy("customer_segment")
        .agg(F.count(F.lit(1)).alias("customer_count"))
    )
