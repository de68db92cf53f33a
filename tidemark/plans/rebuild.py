"""The nightly job: rebuild the lookback window, summarise it, repair what failed."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import LOOKBACK_DAYS, Window, lookback_window
from tidemark.operators.ledger import DigestLedger
from tidemark.operators.profile import date_checksums
from tidemark.operators.profile_states import ProfileStates
from tidemark.operators.reconcile import failing_dates
from tidemark.operators.sink import CLEARED, FAILED, REPLACED, DateOutcome, replace_partitions
from tidemark.schema import PARTITION_COLUMN

# How often a date whose read fails is tried again, and after how many such dates a run gives up.
RETRIES = 2
FAILED_READS = 10


@dataclass(frozen=True)
class RebuildResult:
    """The outcome of every date of a run, newest first."""

    outcomes: list[DateOutcome]

    def by_date(self, spark: SparkSession) -> DataFrame:
        """One row per date of the run; a run has as many dates as its window has days."""
        return spark.createDataFrame(
            [(o.shipment_date, o.rows_written, o.action, o.bad_rows) for o in self.outcomes],
            "shipment_date date, rows_written bigint, action string, bad_rows bigint",
        )

    def failed(self) -> list[DateOutcome]:
        """Dates that stay as they were: rows of theirs do not fit the table, or they could not be read."""
        return [o for o in self.outcomes if o.action == FAILED]

    def check(self) -> RebuildResult:
        """The result itself, or an error that names the failed dates; the others are published."""
        if self.failed():
            texts = [f"{o.shipment_date}: {o.bad_rows} bad rows, {o.problem}" for o in self.failed()]
            raise ValueError("dates not rebuilt: " + "; ".join(texts))
        return self

    def summary(self, spark: SparkSession) -> DataFrame:
        return self.by_date(spark).agg(
            F.count("*").alias("dates_rebuilt"),
            F.min("shipment_date").alias("oldest_date"),
            F.max("shipment_date").alias("newest_date"),
            F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_written"),
            F.count_if(F.col("action") == REPLACED).alias("dates_replaced"),
            F.count_if(F.col("action") == CLEARED).alias("dates_cleared"),
            F.count_if(F.col("action") == FAILED).alias("dates_failed"),
        )


def rebuild(
    source: DataFrame,
    table: str,
    as_of: date | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    missed_nights: int = 0,
    clustered: bool = False,
    fail_all: bool = False,
    ledger: DigestLedger | None = None,
    states: ProfileStates | None = None,
) -> RebuildResult:
    """Replace every date of the window in ``table`` by the source's rows of that date.

    All dates are one job, so small and large ones share the cluster. Dates outside the window
    are neither read nor written. A date with a row that does not fit the table, or one that cannot be read, fails alone and
    stays as it was: ``check()`` of the result raises then. With ``fail_all`` such a date fails the job and
    no date is published. A ledger and profile states record the published dates.
    """
    window = lookback_window(as_of, lookback_days, missed_nights)
    return rebuild_dates(source, table, window.dates(), clustered, fail_all, ledger, states=states)


def rebuild_dates(
    source: DataFrame,
    table: str,
    dates: Iterable[date],
    clustered: bool = False,
    fail_all: bool = False,
    ledger: DigestLedger | None = None,
    retry_wait: float = 0,
    states: ProfileStates | None = None,
) -> RebuildResult:
    """Rebuild any set of dates, down to a single one; replaced files stay for readers until the next run.

    If a job fails, the dates are halved until those are found that cannot be read; these are tried RETRIES times more,
    after ``retry_wait`` seconds each. One such date among n costs about 2 log2 n jobs. After FAILED_READS of them
    the source itself must be out of order: the dates not tried yet fail untried.
    """
    wanted = sorted(set(dates), reverse=True)
    if fail_all:
        outcomes = replace_partitions(source, table, wanted, clustered, retain=True)
    else:
        outcomes = _isolated(source, table, wanted, clustered, retry_wait)
    for recorder in (ledger, states):
        if recorder:
            recorder.record(o.shipment_date for o in outcomes if o.action != FAILED)
    return RebuildResult(outcomes)


def _isolated(
    source: DataFrame, table: str, wanted: list[date], clustered: bool, retry_wait: float
) -> list[DateOutcome]:
    outcomes: dict[date, DateOutcome] = {}
    open_sets = [(wanted, 0)]
    failed = 0
    while open_sets:
        dates, tries = open_sets.pop()
        if failed >= FAILED_READS:
            outcomes |= {d: DateOutcome(d, 0, FAILED, problem="not tried, too many reads failed") for d in dates}
            continue
        try:
            done = replace_partitions(source, table, dates, clustered, isolate=True, retain=True)
        except Exception as error:
            if len(dates) > 1:
                half = len(dates) // 2
                open_sets += [(dates[half:], 0), (dates[:half], 0)]
            elif tries < RETRIES:
                time.sleep(retry_wait)
                open_sets.append((dates, tries + 1))
            else:
                failed += 1
                outcomes[dates[0]] = DateOutcome(dates[0], 0, FAILED, problem=_first_line(error))
        else:
            outcomes |= {o.shipment_date: o for o in done}
    return [outcomes[d] for d in wanted]


def _first_line(error: Exception) -> str:
    return next((line for line in str(error).splitlines() if line.strip()), type(error).__name__)


def repair(source: DataFrame, table: str, report: DataFrame, clustered: bool = False) -> RebuildResult:
    """Rebuild only the dates whose reconciliation failed, each on its own as in ``rebuild``.

    The report has one row per date of a window, and so has the list taken from it.
    """
    dates = [date.fromisoformat(row[0]) for row in failing_dates(report).select("shipment_date").collect()]
    return rebuild_dates(source, table, dates, clustered) if dates else RebuildResult([])


def frozen_checksums(df: DataFrame, window: Window) -> DataFrame:
    """Content checksums of every date older than the window: a few values per date.

    To compare before and after a run, persist or write the result before the run starts.
    """
    return date_checksums(df.filter(F.col(PARTITION_COLUMN) < F.lit(window.first)))


def frozen_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Frozen dates whose content is not what it was; none after a correct run."""
    columns = [c for c in before.columns if c != PARTITION_COLUMN]
    left = before.select(PARTITION_COLUMN, F.struct(*columns).alias("content_before"))
    right = after.select(PARTITION_COLUMN, F.struct(*columns).alias("content_after"))
    return (
        left.join(right, PARTITION_COLUMN, "full_outer")
        .filter(~F.col("content_before").eqNullSafe(F.col("content_after")))
        .select(
            PARTITION_COLUMN,
            F.col("content_before.row_count").alias("rows_before"),
            F.col("content_after.row_count").alias("rows_after"),
        )
    )
