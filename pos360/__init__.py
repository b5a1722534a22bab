"""pos360: retail point-of-sale data quality, 360-level marts, KPIs and RFM
segmentation as lazy Spark DataFrame functions."""

from pos360.params import CORRECTED, DEFAULT, REFERENCE, RunParams

__all__ = ["RunParams", "DEFAULT", "REFERENCE", "CORRECTED"]
