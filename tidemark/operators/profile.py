"""Aggregates that describe a shipment table.

Each is one scan of only the columns it needs, combined map-side before a small shuffle, so a
date or carrier holding most of the rows costs no more than the others.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.bands import BANDS, PENDING_STATUS, PENDING_VERSION, by_band
from tidemark.functions.dates import Window, in_window
from tidemark.functions.fingerprint import checksum_aggregates, combined_checksums


def _date_groups(df: DataFrame, *more: Column) -> DataFrame:
    """A few groups per date, one for each status, from which a status can be picked.

    The minimum of a string over the rows themselves would make Spark sort them all.
    """
    return df.groupBy("shipment_date", "settlement_status").agg(
        F.count("*").alias("row_count"),
        F.min("record_version").alias("min_version"),
        F.max("record_version").alias("max_version"),
        *more,
    )


def per_date_profile(df: DataFrame, window: Window, checksums: bool = False) -> DataFrame:
    """Rows, newest version and a witness status of each date in the window."""
    groups = _date_groups(df.filter(in_window(window)), *(checksum_aggregates() if checksums else []))
    return (
        groups.groupBy("shipment_date")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.max("max_version").alias("max_version"),
            F.min("settlement_status").alias("settlement_status"),
            *(combined_checksums() if checksums else []),
        )
        .withColumn("shipment_date", F.col("shipment_date").cast("string"))
    )


def table_overview(df: DataFrame) -> DataFrame:
    """Totals, date range and distinct counts.

    Grouping by (date, carrier) first leaves a few thousand groups to count distinct values in;
    two distinct counts over the rows themselves would multiply every row.
    """
    return (
        df.groupBy("shipment_date", "carrier_code")
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.min("shipment_date").alias("earliest_date"),
            F.max("shipment_date").alias("latest_date"),
            F.count_distinct("shipment_date").alias("distinct_dates"),
            F.count_distinct("carrier_code").alias("distinct_carriers"),
        )
    )


def status_breakdown(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("settlement_status", "record_version")
        .agg(
            F.count("*").alias("row_count"),
            F.min("actual_cost").alias("min_actual_cost"),
            F.max("actual_cost").alias("max_actual_cost"),
        )
        .orderBy("record_version", "settlement_status")
    )


def carrier_profile(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("carrier_code")
        .agg(
            F.count("*").alias("row_count"),
            F.min("shipment_date").alias("earliest_date"),
            F.max("shipment_date").alias("latest_date"),
        )
        .orderBy("carrier_code")
    )


def recent_dates(df: DataFrame, dates: int = 10) -> DataFrame:
    """The latest dates with their rows, version range and a witness status.

    The dates are taken from the date column alone first; as literals they prune all other partitions.
    """
    latest = df.select("shipment_date").distinct().orderBy(F.desc_nulls_last("shipment_date")).limit(dates).collect()
    return (
        _date_groups(df.filter(F.col("shipment_date") >= F.lit(latest[-1][0])) if latest and latest[-1][0] else df)
        .groupBy("shipment_date")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.min("min_version").alias("min_version"),
            F.max("max_version").alias("max_version"),
            F.min("settlement_status").alias("settlement_status"),
        )
        .orderBy(F.desc("shipment_date"))
        .limit(dates)
    )


def date_version_status(df: DataFrame, as_of: date, days: int = 70) -> DataFrame:
    """Distribution by date, version and status from ``days`` ago on."""
    return (
        df.filter(F.col("shipment_date") >= F.lit(as_of - timedelta(days=days)))
        .groupBy("shipment_date", "record_version", "settlement_status")
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("shipment_date"), "record_version", "settlement_status")
    )


def window_status(df: DataFrame, as_of: date, days: int = 60) -> DataFrame:
    """Distribution by status and version from ``days`` ago on."""
    return (
        df.filter(F.col("shipment_date") >= F.lit(as_of - timedelta(days=days)))
        .groupBy("settlement_status", "record_version")
        .agg(F.count("*").alias("row_count"))
        .orderBy("record_version", "settlement_status")
    )


def frozen_rows(df: DataFrame, as_of: date, days: int = 60) -> DataFrame:
    """Settled rows older than ``days``; the date of exactly that age does not count yet."""
    frozen = (F.col("shipment_date") < F.lit(as_of - timedelta(days=days))) & (
        F.col("settlement_status") == BANDS[-1].status
    )
    return df.filter(frozen).agg(
        F.count("*").alias("frozen_rows"),
        F.min("shipment_date").alias("earliest_frozen"),
        F.max("shipment_date").alias("latest_frozen"),
    )


def version_counts(df: DataFrame) -> DataFrame:
    """All progress counts of a settlement run in one pass."""
    versions = (PENDING_VERSION, *[band.version for band in BANDS])
    return df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(F.col("record_version") == v).alias(f"version_{v}_rows") for v in versions],
    )


def seed_date(df: DataFrame, as_of: date) -> DataFrame:
    """The latest date that is not after ``as_of``, as a single value."""
    return df.filter(F.col("shipment_date") <= F.lit(as_of)).agg(
        F.max("shipment_date").alias("seed_date")
    )


def band_violations(df: DataFrame, as_of: date) -> DataFrame:
    """Groups of rows whose version, status or cost presence does not belong to their age."""
    groups = df.groupBy("shipment_date", "record_version", "settlement_status").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("actual_cost").isNull()).alias("uncosted_rows")
    )
    return violations(groups, as_of)


def violations(groups: DataFrame, as_of: date) -> DataFrame:
    """Of groups by date, version and status with row_count and uncosted_rows those that do not belong to their age."""
    return (
        groups.withColumn("expected_version", by_band(as_of, lambda b: F.lit(b.version), F.lit(PENDING_VERSION)))
        .withColumn("expected_status", by_band(as_of, lambda b: F.lit(b.status), F.lit(PENDING_STATUS)))
        .withColumn(
            "expected_uncosted",
            F.when(F.col("expected_version") == PENDING_VERSION, F.col("row_count")).otherwise(F.lit(0)),
        )
        .filter(
            (F.col("record_version") != F.col("expected_version"))
            | (F.col("settlement_status") != F.col("expected_status"))
            | (F.col("uncosted_rows") != F.col("expected_uncosted"))
        )
        .drop("expected_uncosted")
    )


def date_checksums(df: DataFrame) -> DataFrame:
    """Row count and content checksum of each date."""
    return df.groupBy("shipment_date").agg(F.count("*").alias("row_count"), *checksum_aggregates())
