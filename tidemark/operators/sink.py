"""Writes to the partitioned sink table: append, full load, partition replace, update.

A replaced date is written to a fresh folder first and published by pointing its catalog
partition there. Readers see the old date or the new one, never a part; a failed write publishes
nothing; no rows move at commit time, which on object stores would mean copying them; and the
source is read once, since the staged files themselves tell which dates came back empty.
Each date is atomic by itself. Several dates are published one after another, so a driver lost
in between leaves some old and some new, and running again completes them.

A run leaves a marker in the table's folder while it works, and a note of the folders it retires before
it retires them. The next run reads what is left of these and deletes the files of lost runs and,
where a run was told to retain them for readers, the retired ones. Its cost follows the dates replaced, not the
age of the table.

Read the table through the catalog, not by path, and let one job write at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import on_dates
from tidemark.operators.align import align
from tidemark.schema import PARTITION_COLUMN, STORED_COLUMNS, create_table, stored_schema

REPLACED = "REPLACED"
CLEARED = "CLEARED"
ABSENT = "ABSENT"
FAILED = "FAILED"

# Fixed bound on partitions named in one catalog statement.
_PARTITIONS_PER_STATEMENT = 200
# Fixed bound on catalog statements that run at a time.
_STATEMENTS_AT_ONCE = 8

_DATE_PREFIX = f"{PARTITION_COLUMN}="
# In staged files only: what is wrong with a row.
_PROBLEM = "_problem"
_LOAD = "load-"


@dataclass(frozen=True)
class DateOutcome:
    """What happened to one date: rows written, and whether it was replaced, cleared or absent.

    A failed date stays as it was; bad_rows of its new rows do not fit the table, the first problem in the order of
    their texts among them.
    """

    shipment_date: date
    rows_written: int
    action: str
    bad_rows: int = 0
    problem: str | None = None


@dataclass(frozen=True)
class StagedDates:
    """A written folder with one subfolder for each date that has rows."""

    folder: str
    dates: frozenset[date]

    def rows_per_date(self, spark: SparkSession) -> dict[date, int]:
        """Counted from the Parquet footers; no column is read."""
        counts = (
            spark.read.schema(stored_schema())
            .parquet(self.folder)
            .groupBy(PARTITION_COLUMN)
            .agg(F.count("*").alias("n"))
        )
        return {row[PARTITION_COLUMN]: row["n"] for row in counts.collect()}

    def bad_dates(self, spark: SparkSession) -> dict[date, tuple[int, str]]:
        """Bad rows and a problem of each date that has any; reads the one column of problems."""
        bad = (
            spark.read.schema(stored_schema().add(_PROBLEM, "string"))
            .parquet(self.folder)
            .filter(F.col(_PROBLEM).isNotNull())
            .groupBy(PARTITION_COLUMN)
            .agg(F.count("*").alias("n"), F.min(_PROBLEM).alias("problem"))
        )
        return {row[PARTITION_COLUMN]: (row["n"], row["problem"]) for row in bad.collect()}


def append(df: DataFrame, table: str, clustered: bool = False) -> None:
    """Add rows; nothing that is stored changes."""
    # insertInto goes by position, so the table's own order decides.
    columns = df.sparkSession.table(table).columns
    _laid_out(align(df), clustered).select(*columns).write.insertInto(table)


def stage(df: DataFrame, folder: str, clustered: bool = False, isolate: bool = False) -> StagedDates:
    """Write a frame's rows by date into a folder no table refers to yet.

    With ``isolate`` a row that does not fit the table is written with its problem beside it instead of
    failing the job; see ``StagedDates.bad_dates``.
    """
    rows = align(df, _PROBLEM) if isolate else align(df)
    columns = [c for c in STORED_COLUMNS if c != PARTITION_COLUMN] + [_PROBLEM] * isolate + [PARTITION_COLUMN]
    _laid_out(rows, clustered).select(*columns).write.partitionBy(PARTITION_COLUMN).parquet(folder)
    return StagedDates(folder, frozenset(_HadoopPath(df.sparkSession, folder).dates()))


def full_load(df: DataFrame, table: str, location: str | None = None, clustered: bool = False) -> None:
    """The one-time load of all history into a new table.

    Until it is complete, running it again loads everything anew, also after it was lost halfway
    through publishing; after that the table counts as holding data.
    """
    spark = df.sparkSession
    create_table(spark, table, location)
    stored = partition_dates(spark, table)
    opened = _HadoopPath(spark, f"{_table_location(spark, table)}/_open").children()
    if stored and not any(run.startswith(_LOAD) for run in opened):
        raise ValueError(f"{table} already holds data")
    with _run(spark, table, _LOAD) as folder:
        with _discarded_on_error(spark, table, folder):
            staged = stage(df, folder, clustered)
        publish(spark, table, staged, staged.dates | stored)


def replace_partitions(
    df: DataFrame,
    table: str,
    dates: Iterable[date],
    clustered: bool = False,
    isolate: bool = False,
    retain: bool = False,
) -> list[DateOutcome]:
    """Make each of ``dates`` hold exactly the rows ``df`` has for it; touch no other date.

    A date without rows in ``df`` is cleared. ``clustered`` says that each input task holds rows
    of few dates, as with a scan of a date-partitioned table, so that writing needs no shuffle.
    A row that does not fit the table fails the whole call, or with ``isolate`` its date alone. With
    ``retain`` replaced files stay until the next run, for readers that have planned with them.
    """
    spark = df.sparkSession
    wanted = sorted(set(dates), reverse=True)
    with _run(spark, table) as folder:
        with _discarded_on_error(spark, table, folder):
            staged = stage(df.filter(on_dates(wanted)), folder, clustered, isolate)
            bad = staged.bad_dates(spark) if isolate else {}
            rows = staged.rows_per_date(spark)
        stored = publish(spark, table, staged, set(wanted) - bad.keys(), retain)
        for d in bad:
            _HadoopPath(spark, _date_folder(folder, d)).delete()

    def outcome(d: date) -> DateOutcome:
        if d in bad:
            return DateOutcome(d, 0, FAILED, *bad[d])
        return DateOutcome(d, rows.get(d, 0), REPLACED if d in rows else CLEARED if d in stored else ABSENT)

    return [outcome(d) for d in wanted]


def update_rows(
    spark: SparkSession, table: str, condition: Column, assignments: dict[str, Column]
) -> dict[date, int]:
    """UPDATE for a Parquet table: rewrite only the dates that hold matching rows.

    Returns the changed rows per date. Bound the date in ``condition`` so that both scans prune, and
    leave out rows that already have the new values, since every matching date is rewritten.
    """
    stored = spark.table(table)
    changed = {
        row[PARTITION_COLUMN]: row["n"]
        for row in stored.filter(condition).groupBy(PARTITION_COLUMN).agg(F.count("*").alias("n")).collect()
    }
    if changed:
        updated = stored.withColumns(
            {name: F.when(condition, value).otherwise(F.col(name)) for name, value in assignments.items()}
        )
        replace_partitions(updated, table, changed, clustered=True)
    return changed


def _laid_out(df: DataFrame, clustered: bool) -> DataFrame:
    """Rows of a date together, with hot dates split and small ones merged by adaptive execution."""
    return df if clustered else df.hint("rebalance", F.col(PARTITION_COLUMN))


def publish(
    spark: SparkSession, table: str, staged: StagedDates, wanted: Iterable[date], retain: bool = False
) -> set[date]:
    """Point the table's partitions of ``wanted`` at the staged folders, one date at a time.

    Wanted dates that were not staged end up empty. Folders of the table that held these dates
    before are deleted at the end, with ``retain`` by the next run. Returns the dates the table had before.
    """
    wanted = set(wanted)
    location = _HadoopPath(spark, _table_location(spark, table))
    stored = partition_dates(spark, table)
    replaced = sorted(wanted & stored, reverse=True)
    former = _folders_in_use(spark, table, replaced)
    note = location.child("_retired").child(staged.folder.rsplit("/", 1)[-1])
    retired = [path for path in former if path.startswith(location.plain + "/")]
    if retired:
        note.write("\n".join(retired))

    def point(d: date) -> None:
        target = _date_folder(staged.folder, d)
        if d not in staged.dates:
            # An empty folder, not a dropped partition: a later append to this date must not
            # pick up files that a crash left in the date's default folder.
            _HadoopPath(spark, target).mkdirs()
        spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(d)}) SET LOCATION '{target}'")

    _at_once(spark, point, replaced)
    new_dates = sorted((wanted & staged.dates) - stored)
    for start in range(0, len(new_dates), _PARTITIONS_PER_STATEMENT):
        _add_partitions(spark, table, staged, new_dates[start : start + _PARTITIONS_PER_STATEMENT])
    if retired and not retain:
        _delete_folders(location, retired)
        note.delete()
    return stored


def vacuum(spark: SparkSession, table: str) -> int:
    """Delete every date folder inside the table's own that no partition points at; returns their number.

    For what no note names any more, such as files of runs before a marker could be written. It lists all
    run folders and asks for the location of each date found, so it is maintenance, not part of a run. Let no reader or writer work
    meanwhile.
    """
    location = _HadoopPath(spark, _table_location(spark, table))
    stored = partition_dates(spark, table)
    pointed: dict[date, str] = {}
    unused = []
    for folder in [location, *map(location.child("_runs").child, location.child("_runs").children())]:
        for d in folder.dates():
            if d in stored and d not in pointed:
                pointed[d] = _partition_path(spark, table, d)
            path = folder.child(_date_name(d)).plain
            if pointed.get(d) != path:
                unused.append(path)
        if folder is not location and not folder.dates():
            folder.delete()
    _delete_folders(location, unused)
    for kind in ("_open", "_retired"):
        location.child(kind).delete()
    return len(unused)


@contextmanager
def _run(spark: SparkSession, table: str, prefix: str = "") -> Iterator[str]:
    """A fresh folder inside the table's own, hidden from readers by its underscore.

    It is marked as open until the work is done; what earlier runs left is deleted then.
    """
    location = _HadoopPath(spark, _table_location(spark, table))
    name = prefix + uuid.uuid4().hex
    marker = location.child("_open").child(name)
    marker.write("")
    yield location.child("_runs").child(name).path
    _clean_up(spark, table, location, name)
    marker.delete()


@contextmanager
def _discarded_on_error(spark: SparkSession, table: str, folder: str) -> Iterator[None]:
    """Nothing of a run is left if it fails before it publishes; only a lost driver leaves that to the next run."""
    try:
        yield
    except Exception:
        _HadoopPath(spark, folder).delete()
        _HadoopPath(spark, _table_location(spark, table)).child("_open").child(folder.rsplit("/", 1)[-1]).delete()
        raise


def _at_once(spark: SparkSession, step: Callable[[date], None], dates: list[date]) -> None:
    """The step of every date, several at a time, under the caller's job group and other local properties."""
    if dates:
        with ThreadPoolExecutor(min(_STATEMENTS_AT_ONCE, len(dates))) as pool:
            inheriting = inheritable_thread_target(spark)
            list(pool.map(lambda run: run(), [inheriting(lambda d=d: step(d)) for d in dates]))


def _folders_in_use(spark: SparkSession, table: str, dates: list[date]) -> list[str]:
    """The folders that hold these dates' files, without the scheme; one listing for all of them."""
    if not dates:
        return []
    files = spark.table(table).filter(on_dates(dates)).inputFiles()
    folders = {path.rsplit("/", 1)[0] for path in files}
    return sorted(_HadoopPath(spark, folder).plain for folder in folders)


def _clean_up(spark: SparkSession, table: str, location: _HadoopPath, run: str) -> None:
    """Delete what lost runs staged and what earlier runs retired."""
    lost = set(location.child("_open").children()) - {run}
    notes = set(location.child("_retired").children()) - {run}
    folders = [location.child("_runs").child(name) for name in lost]
    left = [folder.child(_date_name(d)).plain for folder in folders for d in folder.dates()]
    certain = []
    for name in notes:
        paths = location.child("_retired").child(name).read().splitlines()
        # A run lost while it published may have left the old files in use.
        (left if name in lost else certain).extend(paths)
    stored = partition_dates(spark, table) if left else set()

    def in_use(path: str) -> bool:
        d = _date_of(path)
        return d in stored and _partition_path(spark, table, d) == path

    _delete_folders(location, certain + [path for path in set(left) if not in_use(path)])
    for folder in folders:
        if not folder.dates():
            folder.delete()
    for kind, names in (("_retired", notes), ("_open", lost)):
        for name in names:
            location.child(kind).child(name).delete()


def _delete_folders(location: _HadoopPath, paths: Iterable[str]) -> None:
    """Delete date folders, and run folders that hold no date any more."""
    parents = set()
    for path in paths:
        location.at(path).delete()
        parents.add(path.rsplit("/", 1)[0])
    for parent in parents - {location.plain}:
        folder = location.at(parent)
        if not folder.dates():
            folder.delete()


def _add_partitions(spark: SparkSession, table: str, staged: StagedDates, dates: list[date]) -> None:
    parts = " ".join(f"PARTITION ({_spec(d)}) LOCATION '{_date_folder(staged.folder, d)}'" for d in dates)
    spark.sql(f"ALTER TABLE {table} ADD {parts}")


def _date_name(d: date) -> str:
    return _DATE_PREFIX + d.isoformat()


def _spec(d: date) -> str:
    return f"{PARTITION_COLUMN} = DATE '{d.isoformat()}'"


def _date_folder(root: str, d: date) -> str:
    return f"{root}/{_date_name(d)}"


def partition_dates(spark: SparkSession, table: str) -> set[date]:
    names = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return {date.fromisoformat(name.removeprefix(_DATE_PREFIX)) for name in names}


def _table_location(spark: SparkSession, table: str) -> str:
    return _location(spark.sql(f"DESCRIBE TABLE EXTENDED {table}"))


def _partition_path(spark: SparkSession, table: str, d: date) -> str:
    """Where the catalog says that a stored date's files are, without the scheme."""
    return _HadoopPath(spark, _location(spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({_spec(d)})"))).plain


def _location(description: DataFrame) -> str:
    # A partition's own location stands before that of its table.
    return next(row["data_type"] for row in description.collect() if row["col_name"] == "Location")


def _date_of(path: str) -> date:
    return date.fromisoformat(path.rsplit("/", 1)[-1].removeprefix(_DATE_PREFIX))


class _HadoopPath:
    """A file or folder reached through the session's Hadoop settings, wherever it is stored."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    @property
    def plain(self) -> str:
        """The path without its scheme, the same however the location was written."""
        return self._path.toUri().getPath()

    def child(self, name: str) -> _HadoopPath:
        return _HadoopPath(self._spark, f"{self.path}/{name}")

    def at(self, plain: str) -> _HadoopPath:
        """A plain path on the same file system."""
        return _HadoopPath(self._spark, self._files.makeQualified(self._spark._jvm.org.apache.hadoop.fs.Path(plain)).toString())

    def children(self) -> list[str]:
        if not self._files.exists(self._path):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(self._path)]

    def dates(self) -> list[date]:
        return [_date_of(name) for name in self.children() if name.startswith(_DATE_PREFIX)]

    def mkdirs(self) -> None:
        self._files.mkdirs(self._path)

    def write(self, text: str) -> None:
        out = self._files.create(self._path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self) -> str:
        stream = self._files.open(self._path)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text

    def delete(self) -> None:
        self._files.delete(self._path, True)
