"""Lookback windows: literal bounds for planning, a spine as a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOOKBACK_DAYS = 60


def utc_today() -> date:
    """The default processing date; every operator also takes it as an argument."""
    return datetime.now(timezone.utc).date()


@dataclass(frozen=True)
class Window:
    """An inclusive range of dates. Only its two bounds ever reach a plan."""

    first: date
    last: date

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1

    def dates(self) -> list[date]:
        """Every date of the window, newest first."""
        return [self.last - timedelta(days=i) for i in range(self.days)]

    def iso_dates(self) -> list[str]:
        return [d.isoformat() for d in self.dates()]


def lookback_window(
    as_of: date | None = None, lookback_days: int = LOOKBACK_DAYS, missed_nights: int = 0
) -> Window:
    """The dates a nightly run rebuilds: ages 1 .. lookback_days.

    A date is read for the last time at the age where it freezes, so every night that did not
    run must widen the next window by one day; otherwise its oldest date stays stale for good.
    """
    if lookback_days < 1 or missed_nights < 0:
        raise ValueError("lookback_days must be positive and missed_nights not negative")
    as_of = as_of or utc_today()
    return Window(as_of - timedelta(days=lookback_days + missed_nights), as_of - timedelta(days=1))


def in_window(window: Window, column: str = "shipment_date") -> Column:
    """Literal bounds, which Spark turns into partition filters and pushed filters."""
    return F.col(column).between(F.lit(window.first), F.lit(window.last))


def on_dates(dates: Iterable[date], column: str = "shipment_date") -> Column:
    """Membership in a date list; a gapless list becomes a range."""
    ordered = sorted(set(dates))
    if not ordered:
        return F.lit(False)
    hull = Window(ordered[0], ordered[-1])
    if hull.days == 1:
        return F.col(column) == F.lit(hull.first)
    if hull.days == len(ordered):
        return in_window(hull, column)
    # The bounds also reach scans that cannot take the list.
    return in_window(hull, column) & F.col(column).isin([F.lit(d) for d in ordered])


def window_spine(spark: SparkSession, window: Window) -> DataFrame:
    """The window's dates as rows, one for each, even where no data exists."""
    bounds = spark.range(1).select(F.lit(window.first).alias("first"), F.lit(window.last).alias("last"))
    return bounds.select(F.explode(F.sequence("first", "last")).alias("shipment_date"))
