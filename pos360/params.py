"""Run parameters shared by every operator.

``semantics`` picks between the literal behaviour of the original cleaning
and mart scripts (``"reference"``) and the evident intent where the scripts
are defective (``"corrected"``); SURVEY §2.8 lists every such decision.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

REFERENCE = "reference"
CORRECTED = "corrected"


@dataclass(frozen=True)
class RunParams:
    # The year whose order lines the cleaning chain deletes, and
    # the end-of-analysis date of RFM recency.
    drop_year: int = 2020
    rfm_as_of: dt.date = dt.date(2023, 12, 31)
    # Date up to which "inactive days" count; None is the day of the run.
    inactive_as_of: dt.date | None = None
    semantics: str = REFERENCE
    # Number of RFM score buckets; the segments' bands are those of four.
    rfm_tiles: int = 4

    def __post_init__(self) -> None:
        if self.semantics not in (REFERENCE, CORRECTED):
            raise ValueError(f"semantics must be {REFERENCE!r} or {CORRECTED!r}")
        if self.rfm_tiles != 4:
            raise ValueError("the segments' bands of total scores are defined for rfm_tiles=4")

    @property
    def corrected(self) -> bool:
        return self.semantics == CORRECTED

    def with_(self, **kw) -> "RunParams":
        return replace(self, **kw)


DEFAULT = RunParams()
