"""Base shipment rows of any number, for scale runs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.bands import PENDING_STATUS, PENDING_VERSION
from tidemark.schema import CARRIER_COUNT, REGIONS, SHIPMENT_COLUMNS
from tidemark.sources.orders import carrier_code, region

# Spread in days, lowest values and ranges of the random columns.
SPREAD_DAYS = 365
LOWEST_COST, COST_RANGE = 500, 2000
LOWEST_WEIGHT, WEIGHT_RANGE = 100, 900
PAYLOAD_RANGE = 10_000


def generated_shipments(spark: SparkSession, rows: int, as_of: date, seed: int = 0) -> DataFrame:
    """``rows`` pending shipments, ids from 1, spread evenly over the days before ``as_of``.

    Values are hashes of the id, so a task that runs again makes the same rows.
    """
    ids = spark.range(1, rows + 1).withColumnRenamed("id", "shipment_id")

    def pick(column: str, size: int) -> Column:
        return F.pmod(F.xxhash64("shipment_id", F.lit(f"{seed}-{column}")), F.lit(size))

    values = {
        "shipment_id": F.col("shipment_id"),
        "shipment_date": F.date_add(
            F.lit(as_of - timedelta(days=SPREAD_DAYS)), pick("date", SPREAD_DAYS).cast("int")
        ),
        "record_version": F.lit(PENDING_VERSION),
        "settlement_status": F.lit(PENDING_STATUS),
        "carrier_code": carrier_code(pick("carrier", CARRIER_COUNT)),
        "origin_region": region(pick("origin", len(REGIONS))),
        "destination_region": region(pick("destination", len(REGIONS))),
        "estimated_cost": (LOWEST_COST + pick("cost", COST_RANGE)).cast("decimal(18,2)"),
        "actual_cost": F.lit(None).cast("decimal(18,2)"),
        "weight_lbs": (LOWEST_WEIGHT + pick("weight", WEIGHT_RANGE)).cast("decimal(10,2)"),
        "payload": F.concat(
            F.lit("SHIPMENT-BATCH-INITIAL-"), pick("payload", PAYLOAD_RANGE).cast("string")
        ),
    }
    return ids.select(*[values[name].alias(name) for name in SHIPMENT_COLUMNS])
