"""Settlement bands: what a row of a given age must look like."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    """Ages ``youngest`` .. ``oldest`` in days, both inclusive; no ``oldest`` means all older."""

    youngest: int
    oldest: int | None
    version: int
    status: str
    rate: Decimal

    def covers(self, as_of: date, column: str = "shipment_date") -> Column:
        newest = F.col(column) <= F.lit(as_of - timedelta(days=self.youngest))
        if self.oldest is None:
            return newest
        return newest & (F.col(column) >= F.lit(as_of - timedelta(days=self.oldest)))

    def settled_cost(self, column: str = "estimated_cost") -> Column:
        """Exact decimal product, rounded half up to cents."""
        return (F.col(column) * F.lit(self.rate)).cast("decimal(18,2)")


# Age bands with their version, status and cost rate.
SETTLING_FIRST = Band(0, 30, 2, "Settling", Decimal("0.97"))
SETTLING_SECOND = Band(31, 59, 3, "Settling", Decimal("0.95"))
SETTLED = Band(60, None, 4, "Settled", Decimal("0.94"))
BANDS = (SETTLING_FIRST, SETTLING_SECOND, SETTLED)

PENDING_VERSION = 1
PENDING_STATUS = "Pending"


def by_band(as_of: date, pick, otherwise: Column, column: str = "shipment_date") -> Column:
    """``pick(band)`` of the row's band; ``otherwise`` for rows dated after ``as_of``."""
    result = None
    for band in BANDS:
        branch = (band.covers(as_of, column), pick(band))
        result = F.when(*branch) if result is None else result.when(*branch)
    return result.otherwise(otherwise)
