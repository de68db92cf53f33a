"""The one-time load of all history in batches that survive a lost run."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import on_dates
from tidemark.operators.sink import replace_partitions
from tidemark.schema import PARTITION_COLUMN, create_table

#: Rows of a batch, if its dates allow.
ROWS_PER_BATCH = 50_000_000

_COLUMNS = "sink string, first_date date, last_date date, dates_written bigint, rows_written bigint"


@dataclass(frozen=True)
class Batch:
    """The dates of a source from one to another, with its rows."""

    dates: tuple[date, ...]
    rows: int


@dataclass(frozen=True)
class LoadProgress:
    """Date ranges that were loaded completely, a row for each, in a plain table; loads of several sinks may share it."""

    spark: SparkSession
    table: str

    def start(self) -> None:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({_COLUMNS}) USING parquet")

    def ranges(self, sink: str) -> list[tuple[date, date]]:
        rows = self.spark.table(self.table).filter(F.col("sink") == sink).select("first_date", "last_date").collect()
        return [(row[0], row[1]) for row in rows]

    def commit(self, sink: str, batch: Batch) -> None:
        row = (sink, batch.dates[0], batch.dates[-1], len(batch.dates), batch.rows)
        self.spark.createDataFrame([row], _COLUMNS).repartition(1).write.insertInto(self.table)


def batches(rows_per_date: dict[date, int], rows_per_batch: int = ROWS_PER_BATCH) -> Iterator[Batch]:
    """Runs of dates, oldest first; a date goes to the batch in which the rows before it end."""
    before, held, number = 0, [], 0
    for d in sorted(rows_per_date):
        if held and before // rows_per_batch != number:
            yield Batch(tuple(held), sum(rows_per_date[h] for h in held))
            held = []
        number = before // rows_per_batch
        held.append(d)
        before += rows_per_date[d]
    if held:
        yield Batch(tuple(held), sum(rows_per_date[h] for h in held))


def resumable_load(
    source: DataFrame,
    table: str,
    progress: LoadProgress,
    rows_per_batch: int = ROWS_PER_BATCH,
    location: str | None = None,
    clustered: bool = False,
) -> list[Batch]:
    """Load all dates of a source, batch by batch from the oldest on; returns the batches that this run wrote.

    A batch is staged, published and then written down. Run again after it was lost, the load goes on where it
    stopped: what is written down is not read again but for the count of its dates, and a batch that was lost while it was published
    is replaced as a whole. The rows of a source must not change meanwhile. Rows without date fail the load.
    """
    spark = source.sparkSession
    create_table(spark, table, location)
    progress.start()
    done = progress.ranges(table)
    counts = source.groupBy(PARTITION_COLUMN).agg(F.count("*").alias("n")).collect()
    if any(row[PARTITION_COLUMN] is None for row in counts):
        raise ValueError(f"source has rows without {PARTITION_COLUMN}")
    rows = {row[PARTITION_COLUMN]: row["n"] for row in counts}
    written = []
    # Cut alike whatever is done already, so that a batch is either written down or not.
    for batch in batches(rows, rows_per_batch):
        if any(first <= batch.dates[0] and batch.dates[-1] <= last for first, last in done):
            continue
        replace_partitions(source.filter(on_dates(batch.dates)), table, batch.dates, clustered)
        progress.commit(table, batch)
        written.append(batch)
    return written
