"""Scans of shipment tables: named columns, literal date bounds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import Window, in_window
from tidemark.schema import PARTITION_COLUMN, SHIPMENT_COLUMNS


def shipments(spark: SparkSession, table: str) -> DataFrame:
    """All rows, in the fixed column order, so that a column added later does not leak in."""
    return spark.table(table).select(*SHIPMENT_COLUMNS)


def scan_date(df: DataFrame, rebuild_date: date | str) -> DataFrame:
    """The rows of one date; only that partition is read."""
    if isinstance(rebuild_date, str):
        rebuild_date = date.fromisoformat(rebuild_date)
    return df.filter(F.col(PARTITION_COLUMN) == F.lit(rebuild_date)).select(*SHIPMENT_COLUMNS)


def scan_window(df: DataFrame, window: Window) -> DataFrame:
    """The rows of a date range, both ends included."""
    return df.filter(in_window(window)).select(*SHIPMENT_COLUMNS)
