"""Base shipment rows, projected from an orders table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.bands import PENDING_STATUS, PENDING_VERSION
from tidemark.schema import CARRIER_COUNT, REGIONS, SHIPMENT_COLUMNS


def read_orders(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/orders.parquet")


def base_shipments(orders: DataFrame) -> DataFrame:
    """One pending shipment per order.

    Literal bounds on ``shipment_date`` still reach the scan, as bounds on the order timestamp.
    """
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    values = {
        "shipment_id": key,
        "shipment_date": F.col("o_orderdate").cast("date"),
        "record_version": F.lit(PENDING_VERSION),
        "settlement_status": F.lit(PENDING_STATUS),
        "carrier_code": carrier_code(customer % CARRIER_COUNT),
        "origin_region": region(key % len(REGIONS)),
        "destination_region": region(customer % len(REGIONS)),
        "estimated_cost": F.col("o_totalprice").cast("decimal(18,2)"),
        "actual_cost": F.lit(None).cast("decimal(18,2)"),
        "weight_lbs": (F.lit(100) + key % 900).cast("decimal(10,2)"),
        "payload": F.concat(F.lit("SHIPMENT-BATCH-INITIAL-"), (key % 10_000).cast("string")),
    }
    return orders.select(*[values[name].alias(name) for name in SHIPMENT_COLUMNS])


def carrier_code(number: Column) -> Column:
    """'CAR-A' for 0, 'CAR-B' for 1 and so on."""
    return F.concat(F.lit("CAR-"), F.char(F.lit(ord("A")) + number))


def region(number: Column) -> Column:
    """The region with that number; the last one for any number beyond."""
    result = F.when(number == 0, REGIONS[0])
    for i, name in enumerate(REGIONS[1:-1], start=1):
        result = result.when(number == i, name)
    return result.otherwise(REGIONS[-1])
