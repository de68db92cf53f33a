"""Ids for new rows from a persisted high-water mark, so that no history is read to find the largest."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

LARGEST_ID = (1 << 63) - 1

_COLUMNS = "night date, first_id bigint, last_id bigint"


@dataclass(frozen=True)
class IdLedger:
    """Ranges of ids that were given out, a row for each, in a plain table with one writer at a time.

    A range is written down before its ids are used. A run that is lost in between wastes its range; run again for
    the same night it gets the same one, so that its rows keep their ids.
    """

    spark: SparkSession
    table: str

    def start(self, largest: int) -> None:
        """Create the ledger above the largest id in use; the one time that somebody has to know it."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({_COLUMNS}) USING parquet")
        if self.spark.table(self.table).isEmpty():
            self._write(None, None, largest)

    def high_water(self) -> int:
        """The largest id given out."""
        mark = self.spark.table(self.table).agg(F.max("last_id")).first()[0]
        if mark is None:
            raise ValueError(f"{self.table} was not started")
        return mark

    def reserve(self, night: date, rows: int) -> int:
        """The first of so many ids in a row for a night."""
        enough = (F.col("night") == F.lit(night)) & (F.col("last_id") >= F.col("first_id") + rows - 1)
        known, mark = self.spark.table(self.table).agg(F.max(F.when(enough, F.col("first_id"))), F.max("last_id")).first()
        if known is not None:
            return known
        first = self.high_water() + 1 if mark is None else mark + 1
        if first + rows - 1 > LARGEST_ID:
            raise OverflowError(f"{rows} ids from {first} on do not fit a bigint")
        if rows:
            self._write(night, first, first + rows - 1)
        return first

    def _write(self, night: date | None, first: int | None, last: int) -> None:
        self.spark.createDataFrame([(night, first, last)], _COLUMNS).coalesce(1).write.insertInto(self.table)
