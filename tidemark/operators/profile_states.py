"""Profiles of a whole table from stored states of its dates, without reading its history.

A state is what the rows of one date, carrier, status and version come to: counts and extents, all of which merge. A
date has as many states as it has such groups, some dozens at most however many rows it holds. A run that
publishes dates records them: those dates alone are read, and their states stand in the next version of the stored
table. Every profile is then an aggregate of states.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.bands import BANDS, PENDING_VERSION
from tidemark.functions.dates import on_dates
from tidemark.operators.profile import violations
from tidemark.schema import PARTITION_COLUMN
from tidemark.sources.tables import shipments

_KEYS = (PARTITION_COLUMN, "carrier_code", "settlement_status", "record_version")
_COLUMNS = (
    f"{PARTITION_COLUMN} date, carrier_code string, settlement_status string, record_version int, row_count bigint, "
    "uncosted_rows bigint, min_actual_cost decimal(18,2), max_actual_cost decimal(18,2), version bigint"
)


def states_of(df: DataFrame) -> DataFrame:
    """The states of a frame's rows: one per date, carrier, status and version."""
    return df.groupBy(*_KEYS).agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("actual_cost").isNull()).alias("uncosted_rows"),
        F.min("actual_cost").alias("min_actual_cost"),
        F.max("actual_cost").alias("max_actual_cost"),
    )


@dataclass(frozen=True)
class ProfileStates:
    """The states of a sink table, kept in a plain table that only grows; one writer at a time.

    A night adds the states of its window and one file. Dates published by a run that was lost before it recorded them
    are those that a digest ledger calls unrecorded; record them.
    """

    spark: SparkSession
    sink: str
    table: str

    def start(self) -> int:
        """Create the table and record all dates of the sink, the one time that all of it is read."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({_COLUMNS}) USING parquet")
        return self.record() if self.version() < 0 else self.version()

    def version(self) -> int:
        newest = self.spark.table(self.table).agg(F.max("version")).first()[0]
        return -1 if newest is None else newest

    def record(self, dates: Iterable[date] | None = None) -> int:
        """Read these dates, all of them by default, and add a version in which they stand as they are now.

        A date that has no rows any more gets an empty state. Returns the number of the version, which an empty table does
        not raise when all of it is read.
        """
        dates = None if dates is None else sorted(set(dates))
        if dates == []:
            return self.version()
        rows = shipments(self.spark, self.sink)
        if dates is None:
            known = self.spark.table(self.table).select(PARTITION_COLUMN).distinct()
        else:
            known = self.spark.createDataFrame([(d,) for d in dates], f"{PARTITION_COLUMN} date")
            rows = rows.filter(on_dates(dates))
        version = self.version() + 1
        counts = {name: F.coalesce(name, F.lit(0)) for name in ("row_count", "uncosted_rows")}
        held = known.join(states_of(rows), PARTITION_COLUMN, "full_outer").withColumns(counts)
        held = held.withColumn("version", F.lit(version).cast("bigint"))
        held.select(*self.spark.table(self.table).columns).repartition(1).write.insertInto(self.table)
        return self.version()

    def states(self, version: int | None = None) -> DataFrame:
        """The states as they stood at a version, by default now: of every date those recorded last."""
        stored = self.spark.table(self.table)
        stored = stored if version is None else stored.filter(F.col("version") <= version)
        newest = F.max("version").over(Window.partitionBy(PARTITION_COLUMN))
        return stored.withColumn("_newest", newest).filter("version = _newest AND row_count > 0").drop("version", "_newest")


# The profiles of operators.profile, from states.


def table_overview(states: DataFrame) -> DataFrame:
    return states.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.min(PARTITION_COLUMN).alias("earliest_date"),
        F.max(PARTITION_COLUMN).alias("latest_date"),
        F.count_distinct(PARTITION_COLUMN).alias("distinct_dates"),
        F.count_distinct("carrier_code").alias("distinct_carriers"),
    )


def status_breakdown(states: DataFrame) -> DataFrame:
    return (
        states.groupBy("settlement_status", "record_version")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.min("min_actual_cost").alias("min_actual_cost"),
            F.max("max_actual_cost").alias("max_actual_cost"),
        )
        .orderBy("record_version", "settlement_status")
    )


def carrier_profile(states: DataFrame) -> DataFrame:
    return (
        states.groupBy("carrier_code")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.min(PARTITION_COLUMN).alias("earliest_date"),
            F.max(PARTITION_COLUMN).alias("latest_date"),
        )
        .orderBy("carrier_code")
    )


def recent_dates(states: DataFrame, dates: int = 10) -> DataFrame:
    return (
        states.groupBy(PARTITION_COLUMN)
        .agg(
            F.sum("row_count").alias("row_count"),
            F.min("record_version").alias("min_version"),
            F.max("record_version").alias("max_version"),
            F.min("settlement_status").alias("settlement_status"),
        )
        .orderBy(F.desc(PARTITION_COLUMN))
        .limit(dates)
    )


def version_counts(states: DataFrame) -> DataFrame:
    def rows(version: int):
        return F.coalesce(F.sum(F.when(F.col("record_version") == version, F.col("row_count"))), F.lit(0))

    return states.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        *[rows(v).alias(f"version_{v}_rows") for v in (PENDING_VERSION, *[band.version for band in BANDS])],
    )


def seed_date(states: DataFrame, as_of: date) -> DataFrame:
    return states.filter(F.col(PARTITION_COLUMN) <= F.lit(as_of)).agg(F.max(PARTITION_COLUMN).alias("seed_date"))


def band_violations(states: DataFrame, as_of: date) -> DataFrame:
    groups = states.groupBy(PARTITION_COLUMN, "record_version", "settlement_status")
    return violations(groups.agg(*[F.sum(name).alias(name) for name in ("row_count", "uncosted_rows")]), as_of)
