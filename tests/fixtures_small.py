"""Small shipment frames for the operator tests."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.schema import SHIPMENT_COLUMNS

TODAY = date(2024, 3, 15)


def at_age(days: int) -> date:
    return TODAY - timedelta(days=days)


def pending(spark, rows):
    """Pending shipments from (id, date) pairs."""
    frame = spark.createDataFrame(rows, "shipment_id bigint, shipment_date date")
    return frame.select(
        "shipment_id",
        "shipment_date",
        F.lit(1).alias("record_version"),
        F.lit("Pending").alias("settlement_status"),
        F.lit("CAR-A").alias("carrier_code"),
        F.lit("North").alias("origin_region"),
        F.lit("West").alias("destination_region"),
        (F.lit(100) + F.col("shipment_id") % 1000).cast("decimal(18,2)").alias("estimated_cost"),
        F.lit(None).cast("decimal(18,2)").alias("actual_cost"),
        F.lit(Decimal("10.50")).cast("decimal(10,2)").alias("weight_lbs"),
        F.lit("p").alias("payload"),
    ).select(*SHIPMENT_COLUMNS)


def by_age(spark, rows_per_age):
    """Pending shipments: so many rows at each age."""
    rows, next_id = [], 1
    for age, count in rows_per_age.items():
        for _ in range(count):
            rows.append((next_id, at_age(age)))
            next_id += 1
    return pending(spark, rows)


def as_set(df):
    return sorted(tuple(row) for row in df.select(*SHIPMENT_COLUMNS).collect())
