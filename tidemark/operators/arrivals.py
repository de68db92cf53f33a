"""New rows arriving for tomorrow, seeded from the latest date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.bands import PENDING_STATUS, PENDING_VERSION
from tidemark.operators.ids import IdLedger
from tidemark.operators.profile import seed_date
from tidemark.operators.ranges import dense_ids_by_ranges
from tidemark.operators.sink import append, partition_dates
from tidemark.schema import SHIPMENT_COLUMNS
from tidemark.sources.tables import shipments

# Fixed value: the least distance of their ids.
ARRIVAL_ID_OFFSET = 900_000_000

_BINS = 4096


def nightly_arrivals(
    df: DataFrame,
    as_of: date,
    rows: int | None = None,
    id_offset: int | None = None,
) -> DataFrame:
    """Copies of all rows of the latest day, dated the day after ``as_of``.

    ``rows`` caps their number; those with the smallest ids are taken then, so that a re-run gives the
    same arrivals. Ids move by ``id_offset``, by default ARRIVAL_ID_OFFSET or, where the smallest new id would not
    lie beyond all ids up to the seed date, by as much as it takes. Rows dated after ``as_of`` never
    seed, so arrivals do not breed arrivals.

    This is the step of a single night, which reads all ids up to the seed date. ``arrive`` is for a table that gets
    arrivals night after night.
    """
    # A literal date, unlike a subquery, prunes partitions and row groups.
    latest = seed_date(df, as_of).first()[0]
    seeds = df.filter(F.col("shipment_date") == F.lit(latest))
    seeds = seeds if rows is None else smallest_ids(seeds, rows)
    if id_offset is None:
        largest = df.filter(F.col("shipment_date") <= F.lit(as_of)).agg(F.max("shipment_id")).first()[0] or 0
        smallest = seeds.agg(F.min("shipment_id")).first()[0] or 0
        id_offset = max(ARRIVAL_ID_OFFSET, largest + 1 - smallest)
    return _arrived(seeds, as_of, F.col("shipment_id") + F.lit(id_offset).cast("bigint"))


def arrive(spark: SparkSession, table: str, as_of: date, ledger: IdLedger, rows: int | None = None) -> int:
    """Append a night's arrivals to a table; returns their number.

    Seeds are all rows, or the ``rows`` with the smallest ids, of the table's latest date with rows that is not after
    ``as_of``, found in its list of partitions. New ids follow the ledger's high-water mark in the order of the
    seeds' ids, so they grow by the number of rows a night and no other date is read. A night whose rows are there already
    gets none again.
    """
    night = as_of + timedelta(days=1)
    dates = partition_dates(spark, table)
    seeds, count = _latest_rows(spark, table, {d for d in dates if d <= as_of})
    if not count or _latest_rows(spark, table, dates & {night})[1]:
        return 0
    if rows is not None:
        seeds, count = smallest_ids(seeds, rows), min(rows, count)
    rest = [name for name in SHIPMENT_COLUMNS if name != "shipment_id"]
    # Rows equal in every column may change places: their arrivals are equal but for the id.
    ranked = dense_ids_by_ranges(seeds, "shipment_id", *rest, name="rank")
    first = ledger.reserve(night, count)
    append(_arrived(ranked, as_of, F.col("rank") + F.lit(first - 1).cast("bigint")), table, clustered=True)
    return count


def _latest_rows(spark: SparkSession, table: str, dates: set[date]) -> tuple[DataFrame | None, int]:
    """The rows of the latest of these dates that has any, and their number."""
    for day in sorted(dates, reverse=True):
        rows = shipments(spark, table).filter(F.col("shipment_date") == F.lit(day))
        if count := rows.count():
            return rows, count
    return None, 0


def _arrived(seeds: DataFrame, as_of: date, new_id: Column) -> DataFrame:
    arrived = {
        "shipment_id": new_id,
        "shipment_date": F.lit(as_of + timedelta(days=1)),
        "record_version": F.lit(PENDING_VERSION),
        "settlement_status": F.lit(PENDING_STATUS),
        "actual_cost": F.lit(None).cast("decimal(18,2)"),
        "payload": F.concat(
            F.lit("SHIPMENT-NIGHTLY-NEW-"), (F.col("shipment_id") % 10_000).cast("string")
        ),
    }
    return seeds.select(
        *[arrived[name].alias(name) if name in arrived else F.col(name) for name in SHIPMENT_COLUMNS]
    )


def smallest_ids(df: DataFrame, rows: int, key: str = "shipment_id") -> DataFrame:
    """The ``rows`` rows with the smallest keys, without sending ``rows`` of every task to one.

    ``orderBy().limit()`` alone gathers up to ``rows`` candidates from each task in a single
    task. So the key range is first narrowed with small histograms over the key column, until
    few candidates lie below the bound or it cannot get narrower; the bound then reaches the scan.
    Rows with a null key come last: they are taken only if the other rows do not reach ``rows``.
    """
    low, high, total = df.agg(F.min(key), F.max(key), F.count(key)).first()
    below, narrowed = 0, False
    while total > 4 * rows and high > low:
        width = -(-(high - low + 1) // _BINS)
        bins = (
            df.filter(F.col(key).between(low, high))
            .groupBy(F.expr(f"({key} - {low}L) div {width}L").alias("bin"))
            .count()
            .orderBy("bin")
            .collect()
        )
        running = below
        for row in bins:
            if running + row["count"] >= rows:
                break
            running += row["count"]
        low, high = low + row["bin"] * width, min(high, low + (row["bin"] + 1) * width - 1)
        below, total, narrowed = running, running + row["count"], True
    bounded = df.filter(F.col(key) <= high) if narrowed else df
    return bounded.orderBy(F.col(key).asc_nulls_last()).limit(rows)
