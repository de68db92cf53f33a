"""A stored tree of content digests: what a table held, without reading it again.

A node stands for a date, a month or the whole table. It holds the number of rows, a multiset hash of their content and
a hash of the names of their files. All of these merge: a month's node is made of those of its dates, and the
table's of those of its months. A run that publishes dates records them, which reads those dates alone and adds their new nodes, and
the nodes above them, as rows of the next version. Two states are compared from the root: only where nodes
differ are the nodes below looked at, and a table whose root is the same is not read at all.

Files of the sink are never changed in place, so the names of a date's files stand for its content. A date whose
files are not those recorded was changed by somebody else, and is read to see how.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import on_dates
from tidemark.functions.fingerprint import CHECKSUM_COLUMNS, combined_checksums
from tidemark.operators.profile import date_checksums
from tidemark.schema import PARTITION_COLUMN
from tidemark.sources.tables import shipments

DATE, MONTH, TABLE = 0, 1, 2
_CONTENT = ("row_count", *CHECKSUM_COLUMNS)
_FILES = ("file_count", "files_hash")
_COLUMNS = (
    "level int, node date, version bigint, file_count bigint, files_hash bigint, row_count bigint, "
    "hash_xor bigint, hash_sum bigint, estimated_total decimal(28,2), actual_total decimal(28,2)"
)


def date_files(spark: SparkSession, table: str, dates: Iterable[date] | None = None) -> DataFrame:
    """Date, number of files and a hash of their names: a listing of folders, no file is opened."""
    stored = spark.table(table)
    stored = stored if dates is None else stored.filter(on_dates(dates))
    paths = [(path,) for path in stored.inputFiles()]
    found = spark.createDataFrame(paths, "path string").select(
        F.to_date(F.regexp_extract("path", f"{PARTITION_COLUMN}=([0-9-]+)/", 1)).alias("node"),
        F.xxhash64(F.regexp_replace("path", "^[a-z0-9]+:/*", "/")).alias("name_hash"),
    )
    return found.groupBy("node").agg(F.count("*").alias("file_count"), F.bit_xor("name_hash").alias("files_hash"))


@dataclass(frozen=True)
class DigestLedger:
    """The digests of a sink table, kept in a plain table that only grows; one writer at a time."""

    spark: SparkSession
    sink: str
    table: str

    def start(self) -> int:
        """Create the ledger and record all dates of the sink, the one time that all of it is read."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({_COLUMNS}) USING parquet")
        return self.record() if self.version() < 0 else self.version()

    def version(self) -> int:
        newest = self.spark.table(self.table).agg(F.max("version")).first()[0]
        return -1 if newest is None else newest

    def record(self, dates: Iterable[date] | None = None) -> int:
        """Read these dates, all of them by default, and add a version in which they stand as they are now.

        A date without rows gets an empty node. Returns the number of the version.
        """
        dates = None if dates is None else sorted(set(dates))
        if dates == []:
            return self.version()
        version = self.version() + 1
        held = self._held(dates)
        if dates is not None:
            wanted = self.spark.createDataFrame([(d,) for d in dates], "node date")
            held = wanted.join(held, "node", "left")
        self._add(_filled(held), DATE, version)
        months = self._nodes(DATE, version).groupBy(_month().alias("node")).agg(*_merged())
        if dates is not None:
            months = months.filter(F.col("node").isin(sorted({d.replace(day=1) for d in dates})))
        self._add(months, MONTH, version)
        root = self._nodes(MONTH, version).agg(F.lit(None).cast("date").alias("node"), *_merged())
        self._add(_filled(root), TABLE, version)
        return version

    def nodes(self, level: int, version: int | None = None) -> DataFrame:
        """The nodes of a level as they stood at a version, by default now."""
        return self._nodes(level, self.version() if version is None else version)

    def unrecorded(self) -> list[date]:
        """Dates whose files are not those recorded last. Folders are listed; no file is opened."""
        present = date_files(self.spark, self.sink)
        version = self.version()
        found = self._differing(lambda level: self._nodes(level, version), lambda level: _raised(present, level), _FILES)
        return sorted(row["node"] for row in found.select("node").collect()) if found is not None else []

    def changes(self, before: date, since: int) -> DataFrame:
        """Dates before a date whose content is not what it was at a version: their rows then and now.

        Recorded dates are compared by their digests alone. Of all others only those whose files changed are read.
        """
        version, unread = self.version(), [d for d in self.unrecorded() if d < before]

        def then(level: int) -> DataFrame:
            return self._nodes(level, since)

        def now(level: int) -> DataFrame:
            recorded = self._nodes(level, version)
            if not unread:
                return recorded
            dates = self._nodes(DATE, version).filter(~F.col("node").isin(unread))
            changed = dates.select("node", *_CONTENT).unionByName(self._held(unread).select("node", *_CONTENT))
            return _raised(changed, level)

        found = self._differing(then, now, _CONTENT)
        schema = f"{PARTITION_COLUMN} date, rows_before bigint, rows_after bigint"
        if found is None:
            return self.spark.createDataFrame([], schema)
        return found.filter(F.col("node") < F.lit(before)).select(
            F.col("node").alias(PARTITION_COLUMN),
            F.col("then.row_count").alias("rows_before"),
            F.col("now.row_count").alias("rows_after"),
        )

    def _held(self, dates: list[date] | None) -> DataFrame:
        """The nodes of dates from the sink itself; only they are read."""
        rows = shipments(self.spark, self.sink)
        rows = rows if dates is None else rows.filter(on_dates(dates))
        content = date_checksums(rows).withColumnRenamed(PARTITION_COLUMN, "node")
        return content.join(date_files(self.spark, self.sink, dates), "node", "left")

    def _nodes(self, level: int, version: int) -> DataFrame:
        """The newest row of each node that is not after a version."""
        newest = Window.partitionBy("node").orderBy(F.desc("version"))
        return (
            self.spark.table(self.table)
            .filter((F.col("level") == level) & (F.col("version") <= version))
            .withColumn("_newest", F.row_number().over(newest))
            .filter("_newest = 1")
            .drop("_newest", "level", "version")
        )

    def _add(self, nodes: DataFrame, level: int, version: int) -> None:
        rows = nodes.withColumns({"level": F.lit(level), "version": F.lit(version).cast("bigint")})
        names = self.spark.table(self.table).columns
        rows.select(*names).repartition(1).write.insertInto(self.table)

    def _differing(self, left, right, columns: tuple[str, ...]) -> DataFrame | None:
        """Dates whose nodes differ in these columns, found from the root down; None if the roots are equal.

        left and right give the nodes of a level.
        """
        months = None
        for level in (TABLE, MONTH, DATE):
            pair = _paired(left(level), right(level), columns, months)
            if level == DATE:
                return pair
            found = [row["node"] for row in pair.select("node").collect()]
            if not found:
                return None
            months = found if level == MONTH else None
        return None


def _month() -> Column:
    return F.trunc("node", "month")


def _merged() -> list[Column]:
    """The node above from the nodes below it."""
    return [
        F.sum("row_count").alias("row_count"),
        *combined_checksums(),
        F.sum("file_count").alias("file_count"),
        F.bit_xor("files_hash").alias("files_hash"),
    ]


def _raised(dates: DataFrame, level: int) -> DataFrame:
    """Nodes of a level from those of dates, with the columns that they have."""
    if level == DATE:
        return dates
    merged = [c for c, name in zip(_merged(), ("row_count", *CHECKSUM_COLUMNS, *_FILES)) if name in dates.columns]
    if level == MONTH:
        return dates.groupBy(_month().alias("node")).agg(*merged)
    return dates.agg(F.lit(None).cast("date").alias("node"), *merged)


def _filled(nodes: DataFrame) -> DataFrame:
    """Nodes without rows or files hold zeros, sums without values stay null."""
    zero = {name: F.coalesce(name, F.lit(0)) for name in ("row_count", "hash_xor", "hash_sum", *_FILES)}
    return nodes.withColumns(zero)


def _paired(left: DataFrame, right: DataFrame, columns: tuple[str, ...], months: list[date] | None) -> DataFrame:
    """Nodes that differ, a missing one counting as empty: node, then and now."""
    sides = []
    for side, nodes in (("then", left), ("now", right)):
        inside = nodes if months is None else nodes.filter(_month().isin(months))
        # An empty node and none at all are the same.
        values = [F.when(F.col(columns[0]) > 0, F.col(name)).alias(name) for name in columns]
        sides.append(inside.select("node", F.struct(*values).alias(side)))
    joined = sides[0].alias("l").join(sides[1].alias("r"), F.col("l.node").eqNullSafe(F.col("r.node")), "full_outer")
    empty = F.struct(*[F.lit(None).cast(dict(right.dtypes)[name]).alias(name) for name in columns])
    return joined.select(F.coalesce("l.node", "r.node").alias("node"), *[F.coalesce(side, empty).alias(side) for side in ("then", "now")]).filter(
        "NOT (then <=> now)"
    )
