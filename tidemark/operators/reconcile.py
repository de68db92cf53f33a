"""Comparison of a source and a sink, by date and by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import Window, window_spine
from tidemark.functions.fingerprint import CHECKSUM_COLUMNS, bag_hash, row_hash
from tidemark.schema import KEY_COLUMN, PARTITION_COLUMN, SHIPMENT_COLUMNS

PASS = "PASS"
MISMATCH = "MISMATCH"
MISSING_IN_SINK = "MISSING_IN_SINK"
MISSING_IN_SOURCE = "MISSING_IN_SOURCE"
# Results only the deeper checks give.
STALE = "STALE"
ABSENT = "ABSENT"

REPORT_COLUMNS = (
    "shipment_date",
    "row_count_source",
    "row_count_sink",
    "row_diff",
    "validation_result",
    "max_version_source",
    "max_version_sink",
    "status_source",
    "status_sink",
)


def reconcile(source_profile: DataFrame, sink_profile: DataFrame) -> DataFrame:
    """One row per date that either side has, newest first, judged by row counts."""
    return _report(_side_by_side(source_profile, sink_profile), _by_counts())


def deep_reconcile(source_profile: DataFrame, sink_profile: DataFrame) -> DataFrame:
    """As ``reconcile``, but equal counts pass only if versions, statuses and checksums agree."""
    compared = ("max_version", "status", *CHECKSUM_COLUMNS)
    differs = reduce(Column.__or__, [~F.col(f"{c}_source").eqNullSafe(F.col(f"{c}_sink")) for c in compared])
    counted = _by_counts()
    return _report(
        _side_by_side(source_profile, sink_profile), F.when((counted == PASS) & differs, STALE).otherwise(counted)
    )


def _side_by_side(source_profile: DataFrame, sink_profile: DataFrame) -> DataFrame:
    """The values of both profiles in one row per date; those of a side without the date are null.

    The profiles, at most one row per date each, are stacked and grouped: one shuffle of as many rows as
    the window has days, and no join.
    """
    values = [c for c in source_profile.columns if c != "shipment_date"]
    stacked = source_profile.select("shipment_date", *values, F.lit("source").alias("side")).unionByName(
        sink_profile.select("shipment_date", *values, F.lit("sink").alias("side"))
    )
    return stacked.groupBy("shipment_date").agg(
        *[
            F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{c.replace('settlement_', '')}_{side}")
            for c in values
            for side in ("source", "sink")
        ]
    )


def _by_counts() -> Column:
    """The result of a date: a side without rows is missing, otherwise the difference decides."""
    difference = F.col("row_count_sink") - F.col("row_count_source")
    return (
        F.when(difference == 0, PASS)
        .when(difference.isNotNull(), MISMATCH)
        .when(F.col("row_count_source").isNotNull(), MISSING_IN_SINK)
        .otherwise(MISSING_IN_SOURCE)
    )


def _report(sides: DataFrame, result: Column) -> DataFrame:
    rows = [F.coalesce(f"row_count_{side}", F.lit(0)) for side in ("sink", "source")]
    return (
        sides.withColumns({"validation_result": result, "row_diff": rows[0] - rows[1]})
        .select(*REPORT_COLUMNS)
        .orderBy(F.desc("shipment_date"))
    )


def with_absent_dates(report: DataFrame, window: Window) -> DataFrame:
    """The report with a row for every date of the window, also those neither side has."""
    spine = window_spine(report.sparkSession, window).select(F.col("shipment_date").cast("string"))
    return (
        spine.join(report, "shipment_date", "left")
        .withColumns(
            {
                "validation_result": F.coalesce("validation_result", F.lit(ABSENT)),
                "row_diff": F.coalesce("row_diff", F.lit(0)),
            }
        )
        .select(*report.columns)
        .orderBy(F.desc("shipment_date"))
    )


def summarise(report: DataFrame) -> DataFrame:
    """Dates per result."""
    return (
        report.groupBy("validation_result")
        .agg(F.count("*").alias("date_count"))
        .orderBy("validation_result")
    )


def verdict(report: DataFrame) -> DataFrame:
    """Totals and the verdict in one row; several findings can hold at once.

    A comparison without dates, or of absent dates alone, finds nothing and so says ALL_PASSED;
    total_dates and pass_dates tell it from one that compared rows.
    """
    totals = report.agg(
        F.count("*").alias("total_dates"),
        F.count_if(F.col("validation_result") == PASS).alias("pass_dates"),
        F.count_if(F.col("validation_result") == MISSING_IN_SINK).alias("missing_in_sink_dates"),
        F.count_if(F.col("validation_result") == MISSING_IN_SOURCE).alias("missing_in_source_dates"),
        F.count_if(F.col("validation_result") == MISMATCH).alias("mismatch_dates"),
        F.count_if(F.col("validation_result") == STALE).alias("stale_dates"),
    )
    findings = [
        F.when(F.col("mismatch_dates") > 0, "MISMATCHES"),
        F.when(F.col("missing_in_sink_dates") > 0, "MISSING_DATES"),
        F.when(F.col("missing_in_source_dates") > 0, "EXTRA_DATES"),
        F.when(F.col("stale_dates") > 0, "STALE_DATES"),
    ]
    found = F.concat_ws(",", *findings)
    return totals.withColumn("verdict", F.when(found == "", "ALL_PASSED").otherwise(found))


def failing_dates(report: DataFrame) -> DataFrame:
    """Dates a repair has to rebuild."""
    return report.filter(~F.col("validation_result").isin(PASS, ABSENT)).select(
        "shipment_date", "validation_result"
    )


def row_differences(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Ids with rows on one side only, or with other rows on one side than on the other.

    Both sides are stacked and grouped by id, with fixed-size aggregates combined before the
    shuffle. Unlike a join this stays linear when an id is stored many times over.
    Restrict both sides to the dates in question first.
    """
    in_source = F.col("in_source")
    stacked = (
        source.select(*SHIPMENT_COLUMNS, F.lit(True).alias("in_source"))
        .unionByName(sink.select(*SHIPMENT_COLUMNS, F.lit(False).alias("in_source")))
        .withColumn("row_hash", row_hash())
    )
    aggregates = []
    for side, member in (("source", in_source), ("sink", ~in_source)):
        hash_xor, hash_sum = bag_hash(F.when(member, F.col("row_hash")))
        aggregates += [
            F.count_if(member).alias(f"rows_{side}"),
            hash_xor.alias(f"xor_{side}"),
            hash_sum.alias(f"sum_{side}"),
            F.max(F.when(member, F.col(PARTITION_COLUMN))).alias(f"date_{side}"),
            F.max(F.when(member, F.col("record_version"))).alias(f"version_{side}"),
            F.max(F.when(member, F.col("actual_cost"))).alias(f"actual_cost_{side}"),
        ]
    same = (
        (F.col("rows_source") == F.col("rows_sink"))
        & F.col("xor_source").eqNullSafe(F.col("xor_sink"))
        & F.col("sum_source").eqNullSafe(F.col("sum_sink"))
    )
    return (
        stacked.groupBy(KEY_COLUMN)
        .agg(*aggregates)
        .filter(~same)
        .select(
            KEY_COLUMN,
            "date_source",
            "date_sink",
            F.when(F.col("rows_sink") == 0, "ONLY_IN_SOURCE")
            .when(F.col("rows_source") == 0, "ONLY_IN_SINK")
            .otherwise("CHANGED")
            .alias("difference"),
            "rows_source",
            "rows_sink",
            "version_source",
            "version_sink",
            "actual_cost_source",
            "actual_cost_sink",
        )
    )
