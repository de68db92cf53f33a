"""The reconciliation job: profile both sides, compare, give a verdict."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from tidemark.functions.dates import LOOKBACK_DAYS, lookback_window
from tidemark.operators.profile import per_date_profile
from tidemark.operators.reconcile import deep_reconcile, reconcile, summarise, verdict, with_absent_dates


@dataclass(frozen=True)
class Validation:
    report: DataFrame
    summary: DataFrame
    verdict: DataFrame

    def show(self, dates: int | None = None) -> None:
        """All dates of the report, which has as many as its window at most; ``dates`` shows the newest only."""
        dates = self.report.count() if dates is None else dates
        self.report.limit(dates).show(dates, truncate=False)
        self.summary.show(truncate=False)
        self.verdict.show(truncate=False)


@contextmanager
def validation(
    source: DataFrame,
    sink: DataFrame,
    as_of: date | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    deep: bool = False,
    show_absent: bool = False,
    missed_nights: int = 0,
) -> Iterator[Validation]:
    """Report, summary and verdict of one comparison.

    ``deep`` also compares versions, statuses and checksums; ``show_absent`` adds the dates neither
    side has; ``missed_nights`` widens the window as it does for the rebuild that is checked. The report is kept while the block runs, so that each side is scanned once however often the
    three are used. It has one row per date of the window.
    """
    window = lookback_window(as_of, lookback_days, missed_nights)
    compare = deep_reconcile if deep else reconcile
    report = compare(
        per_date_profile(source, window, checksums=deep), per_date_profile(sink, window, checksums=deep)
    )
    report = (with_absent_dates(report, window) if show_absent else report).persist()
    try:
        yield Validation(report, summarise(report), verdict(report))
    finally:
        report.unpersist()
