"""Row differences of two sides that agree almost everywhere, without sending equal rows anywhere.

Dates whose multiset hashes agree are left out first. For each other date the rows of both sides are filed in an
invertible Bloom table: a row adds its id, its hash and a check to three cells, those of the sink with a minus sign, so that
equal rows leave nothing. A cell that holds one kind of row gives it back; taking it out of its other cells frees
more. Each task sends cells, never rows, so a table costs as much as it has cells in the tasks that hold its date; where that
is not well below the date's rows, there is none. Dates whose table cannot be emptied are filed in one eight times
as large. Dates with more differences than the largest holds, and dates that one side lacks, are compared row by row: in the end
only rows of ids that differ, or of such dates, are shuffled. Ids too many to be sent to every task are not looked for:
then all rows are grouped, which shuffles one state of each id and task where a join would shuffle every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import on_dates
from tidemark.functions.fingerprint import bag_hash, row_hash
from tidemark.operators.reconcile import row_differences
from tidemark.schema import KEY_COLUMN, PARTITION_COLUMN, SHIPMENT_COLUMNS
from tidemark.session import scratch_path

#: Cells of a date's table, round by round; each is cut in three, and a row goes to one cell of each third.
CELLS = (96, 768, 6_144, 49_152)
#: Differences for each cell that a table is expected to give back; three cells a row bear 0.81 in the limit.
LOAD = 0.7
#: Cells that the tasks of a round may send for each row of a date; the rounds together then cost less than grouping its rows.
CELLS_PER_ROW = 0.5
#: Ids that are sent to every task. Where rows of more ids are concerned, all rows are grouped.
IDS_SENT = 1 << 20
_THIRDS = 3
# A third has at most 2**14 cells, so 21 bits of a hash spread evenly over it.
_FIELD_BITS = 21
_PRIME = (1 << 31) - 1
_SUMS = ("id_high", "id_low", "hash_high", "hash_low", "check_sum")
_LOW = (1 << 32) - 1


def sparse_row_differences(source: DataFrame, sink: DataFrame, cells: tuple[int, ...] = CELLS) -> DataFrame:
    """What ``row_differences`` gives, at the cost of the differences where sides agree mostly.

    Both sides are read once for the hashes of their dates, once more on the dates that differ for every round, and
    once for the rows of differing ids, or for all rows where those ids are many. Repeated rows count as often as they
    stand. Rows without id or date are compared row by row.
    """
    sides = [side.select(*SHIPMENT_COLUMNS) for side in (source, sink)]
    whole, found = [], []
    left = {}
    undated = F.lit(False)
    rows, concerned_rows = 0, 0
    for row in _dates(*sides).collect():
        day, counts = row[PARTITION_COLUMN], (row["rows_source"], row["rows_sink"])
        rows += sum(counts)
        if row["kinds"] == 1:
            continue
        if day is None:
            undated = F.col(PARTITION_COLUMN).isNull()
            concerned_rows += sum(counts)
        elif min(counts) == 0:
            whole.append(day)
            concerned_rows += sum(counts)
        else:
            left[day] = (*counts, row["tasks"])

    def too_many(ids: int) -> bool:
        return ids > IDS_SENT or 2 * ids > rows

    for size in cells:
        # A table that costs more than the rows it stands for, or too small for the rows that one side has more, is of no use.
        fits = [d for d, (a, b, tasks) in left.items() if abs(a - b) <= LOAD * size and size * tasks <= CELLS_PER_ROW * (a + b)]
        # Every date has as many differences as one side has rows more, at least.
        if fits and not too_many(concerned_rows + sum(abs(a - b) for a, b, _ in left.values())):
            peeled = _peeled(sides, fits, size)
            failed = {row[PARTITION_COLUMN] for row in peeled.filter(~F.col("emptied")).select(PARTITION_COLUMN).collect()}
            found.append(peeled.filter("emptied").select(KEY_COLUMN))
            concerned_rows += found[-1].count()
            left = {d: counts for d, counts in left.items() if d in failed or d not in fits}
    if too_many(concerned_rows + sum(a + b for a, b, _ in left.values())):
        return row_differences(*sides)
    whole += left
    if whole:
        found += [side.filter(on_dates(whole)).select(KEY_COLUMN) for side in sides]
    found += [side.filter(F.col(KEY_COLUMN).isNull() | undated).select(KEY_COLUMN) for side in sides]
    ids = found[0]
    for more in found[1:]:
        ids = ids.unionByName(more)
    ids = F.broadcast(ids.distinct())

    def concerned(side: DataFrame) -> DataFrame:
        same = F.col(f"rows.{KEY_COLUMN}").eqNullSafe(F.col(f"ids.{KEY_COLUMN}"))
        return side.alias("rows").join(ids.alias("ids"), same, "left_semi")

    return row_differences(*map(concerned, sides))


def _dates(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Every date, null among them, with the rows of each side, the tasks that hold them, and kinds: 1 where sides are the same."""
    counts = []
    for side, rows in (("source", source), ("sink", sink)):
        hash_xor, hash_sum = bag_hash(row_hash())
        hashed = rows.withColumn("task", F.spark_partition_id()).groupBy(PARTITION_COLUMN)
        sums = [F.count("*").alias("n"), hash_xor.alias("x"), hash_sum.alias("s"), F.count_distinct("task").alias("tasks")]
        counts.append(hashed.agg(*sums).withColumn("side", F.lit(side)))
    stacked = counts[0].unionByName(counts[1]).groupBy(PARTITION_COLUMN)
    held = {side: F.col("side") == side for side in ("source", "sink")}
    return stacked.agg(
        *[F.coalesce(F.max(F.when(mine, F.col("n"))), F.lit(0)).alias(f"rows_{side}") for side, mine in held.items()],
        F.sum("tasks").alias("tasks"),
        (F.count_distinct(F.struct("n", "x", "s")) + F.when(F.count("*") < 2, 1).otherwise(0)).alias("kinds"),
    )


def _peeled(sides: list[DataFrame], dates: list[date], size: int) -> DataFrame:
    """shipment_date, shipment_id and emptied: ids of rows that differ on each date, or one row that says it failed."""
    third = size // _THIRDS
    stacked = None
    for sign, rows in zip((1, -1), sides):
        rows = rows.filter(on_dates(dates) & F.col(KEY_COLUMN).isNotNull())
        part = rows.select(PARTITION_COLUMN, KEY_COLUMN, row_hash().alias("hash"), F.lit(sign).cast("bigint").alias("sign"))
        stacked = part if stacked is None else stacked.unionByName(part)
    places = [
        F.lit(i * third) + F.shiftright("hash", i * _FIELD_BITS).bitwiseAND((1 << _FIELD_BITS) - 1) % third
        for i in range(_THIRDS)
    ]
    values = {
        "id_high": F.shiftright(KEY_COLUMN, 32),
        "id_low": F.col(KEY_COLUMN).bitwiseAND(_LOW),
        "hash_high": F.shiftright("hash", 32),
        "hash_low": F.col("hash").bitwiseAND(_LOW),
        "check_sum": _check_column(),
    }
    filed = stacked.select(PARTITION_COLUMN, "sign", *[v.alias(k) for k, v in values.items()], F.explode(F.array(*places)).alias("cell"))
    table = filed.groupBy(PARTITION_COLUMN, "cell").agg(
        F.sum("sign").alias("n"), *[F.sum(F.col("sign") * F.col(name)).alias(name) for name in _SUMS]
    )
    some_left = F.lit(False)
    for name in ("n", *_SUMS):
        some_left = some_left | (F.col(name) != 0)

    def peel(cells: pd.DataFrame) -> pd.DataFrame:
        return _peel(cells, third)

    path = scratch_path(sides[0].sparkSession, "peeled")
    table.filter(some_left).groupBy(PARTITION_COLUMN).applyInPandas(
        peel, f"{PARTITION_COLUMN} date, {KEY_COLUMN} bigint, emptied boolean"
    ).write.parquet(path)
    return sides[0].sparkSession.read.schema(f"{PARTITION_COLUMN} date, {KEY_COLUMN} bigint, emptied boolean").parquet(path)


def _check_column() -> Column:
    """A value of a row that sums of other rows do not have but by chance."""
    parts = [
        F.col("hash").bitwiseAND(_PRIME),
        F.shiftrightunsigned("hash", 33),
        F.col(KEY_COLUMN).bitwiseAND(_PRIME),
    ]
    squares = [(part * part) % _PRIME for part in parts]
    return squares[0] + squares[1] + squares[2]


def _check(key: int, hashed: int) -> int:
    parts = (hashed & _PRIME, (hashed & ((1 << 64) - 1)) >> 33, key & _PRIME)
    return sum(part * part % _PRIME for part in parts)


def _row_of(cell: list[int]) -> tuple[int, int, int] | None:
    """Id, hash and count of the rows in a cell that holds one kind of row, else None."""
    n = cell[0]
    if n == 0 or any(value % n for value in cell[1:]):
        return None
    id_high, id_low, hash_high, hash_low, check = (value // n for value in cell[1:])
    if not (0 <= id_low <= _LOW and 0 <= hash_low <= _LOW):
        return None
    key, hashed = (id_high << 32) + id_low, (hash_high << 32) + hash_low
    bound = 1 << 63
    if not (-bound <= key < bound and -bound <= hashed < bound) or _check(key, hashed) != check:
        return None
    return key, hashed, n


def _places(hashed: int, third: int) -> Iterator[int]:
    for i in range(_THIRDS):
        yield i * third + ((hashed >> (i * _FIELD_BITS)) & ((1 << _FIELD_BITS) - 1)) % third


def _peel(cells: pd.DataFrame, third: int) -> pd.DataFrame:
    """Rows given back by one date's table, whose cells are as many as the round allows."""
    day = cells[PARTITION_COLUMN].iloc[0]
    table = {int(row[0]): [int(v) for v in row[1:]] for row in cells[["cell", "n", *_SUMS]].itertuples(index=False)}
    ids, open_cells = set(), list(table)
    # Every row taken out empties a cell for good, unless sums of rows passed for a row; then the date fails.
    steps = 8 * _THIRDS * third
    while open_cells and steps:
        steps -= 1
        place = open_cells.pop()
        row = _row_of(table[place]) if place in table else None
        if row is None:
            continue
        key, hashed, n = row
        if place not in _places(hashed, third):
            continue
        ids.add(key)
        values = (1, key >> 32, key & _LOW, hashed >> 32, hashed & _LOW, _check(key, hashed))
        for other in _places(hashed, third):
            left = [a - n * b for a, b in zip(table.get(other, [0] * len(values)), values)]
            if any(left):
                table[other] = left
                open_cells.append(other)
            else:
                table.pop(other, None)
    emptied = not table
    found = sorted(ids) if emptied else [None]
    return pd.DataFrame({PARTITION_COLUMN: [day] * len(found), KEY_COLUMN: pd.array(found, "Int64"), "emptied": emptied})
