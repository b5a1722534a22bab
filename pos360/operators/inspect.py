"""Inspection helper (the original's ``select *`` looks at a table)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """At most ``n`` rows of ``df`` for a look; which rows is unspecified,
    so it is not a registered query (the full table is the cleaners' output)."""
    return df.limit(n)
