"""Reads from a relational source, with the work the source can do left to it."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import Window
from tidemark.schema import SHIPMENT_COLUMNS

PARALLEL_READERS = 5
ROWS_PER_READER = 5_000_000


def _date_literals(window: Window) -> str:
    return f"'{window.first.isoformat()}' AND '{window.last.isoformat()}'"


def profile_query(table: str, window: Window) -> str:
    """Per-date profile as a derived table, so that one row per date crosses the network."""
    return (
        "(SELECT CAST(shipment_date AS VARCHAR(10)) AS shipment_date, COUNT(*) AS row_count, "
        "MAX(record_version) AS max_version, MIN(settlement_status) AS settlement_status "
        f"FROM {table} WHERE shipment_date BETWEEN {_date_literals(window)} "
        "GROUP BY shipment_date) date_profile"
    )


def extent_query(table: str, window: Window) -> str:
    """Rows and id range of each date as a derived table."""
    return (
        "(SELECT shipment_date, COUNT(*) AS row_count, MIN(shipment_id) AS first_id, "
        "MAX(shipment_id) AS last_id "
        f"FROM {table} WHERE shipment_date BETWEEN {_date_literals(window)} "
        "GROUP BY shipment_date) date_extent"
    )


def date_predicates(
    dates: Iterable[date],
    extents: dict[date, tuple[int, int, int]] | None = None,
    rows_per_reader: int = ROWS_PER_READER,
) -> list[str]:
    """One predicate per date; a date with many rows is cut into id ranges.

    ``extents`` holds (rows, first id, last id) per date. The outermost ranges are open, so rows
    that arrive after the extents were taken are still read.
    """
    predicates = []
    for d in dates:
        on_date = f"shipment_date = '{d.isoformat()}'"
        rows, first, last = (extents or {}).get(d, (0, 0, 0))
        pieces = min(-(-rows // rows_per_reader), last - first + 1)
        if pieces <= 1:
            predicates.append(on_date)
            continue
        cuts = [first + (last - first + 1) * i // pieces for i in range(1, pieces)]
        # A row without id goes to the first range and fails the required column there, as it does uncut.
        predicates.append(f"{on_date} AND (shipment_id < {cuts[0]} OR shipment_id IS NULL)")
        predicates += [
            f"{on_date} AND shipment_id >= {low} AND shipment_id < {high}"
            for low, high in zip(cuts, cuts[1:])
        ]
        predicates.append(f"{on_date} AND shipment_id >= {cuts[-1]}")
    return predicates


def read_profile(
    spark: SparkSession, url: str, table: str, window: Window, properties: dict[str, str]
) -> DataFrame:
    """The source's per-date profile, aggregated there."""
    profile = spark.read.jdbc(url=url, table=profile_query(table, window), properties=properties)
    # Databases differ in the types of COUNT and in the case of names.
    return profile.select(
        F.col("shipment_date").cast("string"),
        F.col("row_count").cast("bigint"),
        F.col("max_version").cast("int"),
        F.col("settlement_status").cast("string"),
    )


def read_window(
    spark: SparkSession,
    url: str,
    table: str,
    window: Window,
    properties: dict[str, str],
    max_parallel: int = PARALLEL_READERS,
    rows_per_reader: int = ROWS_PER_READER,
) -> DataFrame:
    """The window's rows, read over at most ``max_parallel`` connections at a time.

    Every date, or piece of a large one, is its own query and may see the source at a slightly
    different moment.
    """
    extents = {
        row[0]: (row[1], row[2], row[3])
        for row in spark.read.jdbc(url=url, table=extent_query(table, window), properties=properties)
        .select("shipment_date", "row_count", "first_id", "last_id")
        .collect()
    }
    predicates = date_predicates(window.dates(), extents, rows_per_reader)
    return (
        spark.read.jdbc(url=url, table=table, predicates=predicates, properties=properties)
        .select(*SHIPMENT_COLUMNS)
        .coalesce(max_parallel)
    )
