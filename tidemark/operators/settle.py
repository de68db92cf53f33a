"""Settlement of rows by their age."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bands import SETTLING_FIRST, SETTLING_SECOND, Band, by_band


def settle(df: DataFrame, as_of: date) -> DataFrame:
    """Every row as it stands on ``as_of``; rows dated later are left as they are.

    One projection does what an update per band would do in three passes.
    """
    return df.withColumns(
        {
            "record_version": by_band(as_of, lambda b: F.lit(b.version), F.col("record_version")),
            "settlement_status": by_band(as_of, lambda b: F.lit(b.status), F.col("settlement_status")),
            "actual_cost": by_band(as_of, lambda b: b.settled_cost(), F.col("actual_cost")),
        }
    )


def band_assignments(band: Band) -> dict[str, Column]:
    """Column values that move a row into the band."""
    return {
        "record_version": F.lit(band.version),
        "settlement_status": F.lit(band.status),
        "actual_cost": band.settled_cost(),
    }


def crosses_boundary(as_of: date) -> Column:
    """Rows that left the first band today and still carry its version."""
    boundary = as_of - timedelta(days=SETTLING_SECOND.youngest)
    return (F.col("shipment_date") == F.lit(boundary)) & (
        F.col("record_version") == SETTLING_FIRST.version
    )


def advance_boundary(df: DataFrame, as_of: date) -> DataFrame:
    """The frame with the rows of ``crosses_boundary`` moved into the next band."""
    moved = crosses_boundary(as_of)
    return df.withColumns(
        {
            name: F.when(moved, value).otherwise(F.col(name))
            for name, value in band_assignments(SETTLING_SECOND).items()
        }
    )
